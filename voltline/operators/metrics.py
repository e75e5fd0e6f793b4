"""Operational metrics over Silver / alert tables (dashboard figures)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltline.functions.timefmt import hub_latency_ms, interval_us

from voltline.operators.streamsql import (BATTERY_CRITICAL_PCT, TEMP_HIGH_C, TEMP_LOW_C,
                                         threshold_alerts)


def throughput_series(tel: DataFrame, bucket: str = "2 seconds", points: int = 40) -> DataFrame:
    """Events per second in the ``points`` consecutive buckets up to the newest
    one, newest first; buckets without events are there with 0.  No events, no rows.

    The newest ``points`` non-empty buckets cover that span, so the spine is
    built from these few rows, in the same pass."""
    us = interval_us(bucket)
    counts = (tel.where(F.col("event_timestamp").isNotNull())
              .groupBy(F.floor(F.unix_micros("event_timestamp") / F.lit(us)).alias("slot"))
              .agg(F.count(F.lit(1)).alias("events")))
    newest = counts.orderBy(F.desc("slot")).limit(points).agg(
        F.max("slot").alias("newest"), F.map_from_entries(F.collect_list(F.struct("slot", "events"))).alias("by_slot"))
    spine = newest.where(F.col("newest").isNotNull()).select(
        F.explode(F.sequence(F.col("newest") - (points - 1), F.col("newest"))).alias("slot"), "by_slot")
    events = F.coalesce(F.try_element_at("by_slot", F.col("slot")), F.lit(0).cast("long"))
    return (spine.select(F.timestamp_micros(F.col("slot") * us).alias("window_start"),
                         F.timestamp_micros((F.col("slot") + 1) * us).alias("window_end"), events.alias("events"))
            .withColumn("events_per_sec", F.col("events") / F.lit(us / 1e6)).orderBy(F.desc("window_start")))


def latency_percentiles(tel: DataFrame, approx: bool = False) -> DataFrame:
    """p50 / p95 / p99 of hub latency per device type.

    Exact (default): latency is an integer number of milliseconds, so each
    partial aggregate is a map of distinct values -> counts, bounded by the
    latency range rather than by the number of rows.  ``approx=True`` uses
    percentile_approx (fixed-size sketch, relative rank error 1e-4) for very
    wide latency ranges."""
    lat = hub_latency_ms()

    def pct(p):
        if approx:
            return F.percentile_approx("lat", p, 10000).cast("double")
        return F.percentile("lat", p)
    return (tel.where(F.col("event_timestamp").isNotNull())
            .select("device_type", lat.alias("lat"))
            .groupBy("device_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 pct(0.5).alias("p50_ms"), pct(0.95).alias("p95_ms"), pct(0.99).alias("p99_ms"),
                 F.max("lat").alias("max_ms")))


def events_per_day(tel: DataFrame) -> DataFrame:
    return (tel.groupBy(F.to_date("event_timestamp").alias("event_day"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_distinct("device_id").alias("devices"),
                 F.count_if(F.col("anomaly_flag")).alias("anomalies")))


def _latest(tel: DataFrame):
    return tel.select(F.max("event_timestamp")).scalar()


def anomaly_rate_recent(tel: DataFrame, minutes: int = 5) -> DataFrame:
    """Share of anomalous events in the last ``minutes`` before the newest
    event time (one row)."""
    recent = tel.where(F.col("event_timestamp")
                       > _latest(tel) - F.make_dt_interval(mins=F.lit(minutes)))
    return (recent.agg(F.count(F.lit(1)).alias("events"),
                       F.count_if(F.col("anomaly_flag")).alias("anomalies"))
            .withColumn("anomaly_rate_pct",
                        F.round(F.lit(100.0) * F.col("anomalies") / F.nullif(F.col("events"), F.lit(0)), 2)))


def active_devices(tel: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct devices seen, per device type.  Exact by default (a two-level
    aggregation, no single-task step); ``approx=True`` uses a HyperLogLog++
    sketch (rsd 1 %), whose state per group is fixed-size."""
    distinct = (F.approx_count_distinct("device_id", 0.01) if approx
                else F.count_distinct("device_id"))
    return (tel.groupBy("device_type")
            .agg(distinct.alias("active_devices"), F.count(F.lit(1)).alias("events")))


def recent_alerts(tel: DataFrame, k: int = 8, minutes: int = 5) -> DataFrame:
    """Newest ``k`` threshold alerts (total order: time, then id) and the
    number of alerts raised in the last ``minutes``."""
    al = threshold_alerts(tel)
    latest = al.select(F.max("detected_at")).scalar()
    recent_n = al.where(F.col("detected_at") > latest - F.make_dt_interval(mins=F.lit(minutes))) \
                 .select(F.count(F.lit(1))).scalar()
    return (al.orderBy(F.desc("detected_at"), F.desc("event_id")).limit(k)
            .select("event_id", "device_id", "alert_type", "detected_at",
                    recent_n.alias("alerts_last_5m")))


def region_throughput(silver: DataFrame) -> DataFrame:
    """Events per second by region over the observed span, and each
    region's share of the busiest region.  One pass: span and maximum come from
    the rows by region, which are few."""
    at = F.col("event_timestamp")
    per = silver.groupBy("region").agg(F.count(at).alias("events"), F.min(at).alias("first"), F.max(at).alias("last"))
    every = Window.partitionBy()
    span = (F.unix_micros(F.max("last").over(every)) - F.unix_micros(F.min("first").over(every))) / F.lit(1_000_000.0)
    return (per.where("events > 0")
            .select("region", "events", (F.col("events") / span).alias("events_per_sec"),
                    (F.lit(100.0) * F.col("events") / F.max("events").over(every)).alias("pct_of_busiest")))


# Layer SLA targets (seconds) and trigger / window settings.
SLA_TARGETS = {"bronze": 30, "silver": 120, "gold": 900}
BRONZE_TRIGGER_S, SILVER_TRIGGER_S, GOLD_TRIGGER_S = 10, 30, 60
GOLD_WINDOW_S, GOLD_WATERMARK_S = 300, 120


def sla_attainment(tel: DataFrame) -> DataFrame:
    """Worst-case availability lag per layer against its target.

    bronze = slowest hub arrival + bronze trigger; silver = bronze + silver
    trigger; gold = silver + KPI window + watermark + KPI trigger.
    pct = min(100, lag / target * 100): < 60 green, < 85 amber, else red."""
    hub = tel.agg(F.max(hub_latency_ms()).alias("ms"))
    bronze = F.col("ms") / F.lit(1000.0) + F.lit(float(BRONZE_TRIGGER_S))
    silver = bronze + F.lit(float(SILVER_TRIGGER_S))
    gold = silver + F.lit(float(GOLD_WINDOW_S + GOLD_WATERMARK_S + GOLD_TRIGGER_S))
    rows = F.array(*[F.struct(F.lit(name).alias("layer"), lag.alias("actual_sec"),
                              F.lit(float(SLA_TARGETS[name])).alias("target_sec"))
                     for name, lag in (("bronze", bronze), ("silver", silver), ("gold", gold))])
    out = hub.select(F.explode(rows).alias("r")).select("r.*")
    pct = F.least(F.lit(100.0), F.col("actual_sec") / F.col("target_sec") * F.lit(100.0))
    return (out.withColumn("pct", pct)
            .withColumn("status", F.when(F.col("pct") < 60, "green")
                        .when(F.col("pct") < 85, "amber").otherwise("red")))


def event_log(silver: DataFrame, rejects: DataFrame, k: int = 80) -> DataFrame:
    """Newest ``k`` pipeline log lines: threshold alerts, quality warnings
    and dead letters, stamped with their hub arrival time."""
    def line(wanted, badge, message):
        return F.when(wanted, F.struct(F.lit(badge).alias("badge"), message.alias("message")))
    alert = (F.col("anomaly_flag") | (F.col("temperature_c") > TEMP_HIGH_C)
             | (F.col("temperature_c") < TEMP_LOW_C) | (F.col("battery_pct") < BATTERY_CRITICAL_PCT))
    lines = F.array_compact(F.array(
        line(alert, "ALERT", F.concat_ws(" ", F.lit("alert on"), "device_id")),
        line(~F.col("is_valid"), "WARN", F.concat_ws(" ", F.array_join("quality_flags", ","), F.lit("on"), "device_id"))))
    seen = (silver.select(F.col("kafka_timestamp").alias("log_time"), F.col("event_id").alias("ref"),
                          F.explode(lines).alias("line"))  # one pass for both kinds of line
            .select("log_time", "line.badge", "ref", "line.message"))
    dead = rejects.select(F.col("kafka_timestamp").alias("log_time"), F.lit("ERROR").alias("badge"),
                          F.concat(F.lit("offset-"), F.col("kafka_offset").cast("string")).alias("ref"),
                          F.concat_ws(" ", F.lit("dead letter"), "reject_reason").alias("message"))
    return (seen.unionByName(dead)
            .orderBy(F.desc("log_time"), "badge", F.desc("ref")).limit(k))
