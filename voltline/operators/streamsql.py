"""The four windowed stream queries (tumbling, hopping, threshold alerts,
sessions) expressed as DataFrame functions over typed telemetry.

Windows here are closed on the right, (start, end], and the window end is
the query's timestamp; see ``asa_window``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.functions.stats import merged_aggs, merged_mean, merged_stddev, moment_aggs
from voltline.functions.timefmt import asa_window, interval_us


def _asa_w(ts_col: str, pre_shifted: bool, size: str, slide: str | None = None):
    if not pre_shifted:
        return asa_window(ts_col, size, slide)
    return F.window(ts_col, size, slide) if slide else F.window(ts_col, size)


def shift_for_asa(df: DataFrame, name: str = "asa_ts") -> DataFrame:
    """Add the event time moved back by 1 us.  Streaming jobs put the
    watermark on this column so the (start, end] windows are recognised as
    event-time windows."""
    return df.withColumn(name, F.col("event_timestamp") - F.expr("INTERVAL 1 MICROSECOND"))


def tumbling_by_type(tel: DataFrame, size: str = "1 minute", ts_col: str = "event_timestamp",
                     pre_shifted: bool = False) -> DataFrame:
    """Per device type and 1-minute window: counts, temperature / humidity /
    battery statistics, anomaly count and rate."""
    flag = F.col("anomaly_flag").cast("long")
    return (
        tel.groupBy(_asa_w(ts_col, pre_shifted, size).alias("w"), "device_type")
        .agg(F.count(F.lit(1)).alias("event_count"),
             F.avg("temperature_c").alias("avg_temperature_c"),
             F.max("temperature_c").alias("max_temperature_c"),
             F.min("temperature_c").alias("min_temperature_c"),
             F.avg("humidity_pct").alias("avg_humidity_pct"),
             F.avg("battery_pct").alias("avg_battery_pct"),
             F.sum(flag).alias("anomaly_count"))
        .select(F.col("w.end").alias("window_end"), F.col("w.start").alias("window_start"),
                "device_type", "event_count", "avg_temperature_c", "max_temperature_c",
                "min_temperature_c", "avg_humidity_pct", "avg_battery_pct", "anomaly_count",
                F.round(F.lit(100.0) * F.col("anomaly_count").cast("double")
                        / F.nullif(F.col("event_count"), F.lit(0)), 2).alias("anomaly_rate_pct"))
    )


def hopping_by_device(tel: DataFrame, size: str = "5 minutes", hop: str = "1 minute",
                      ts_col: str = "event_timestamp", pre_shifted: bool = False,
                      after: str | None = None) -> DataFrame:
    """Per device and overlapping 5-minute window every minute.  ``after``
    (streams): a column; a row counts in the windows that end after it.

    Batch: readings are first reduced to one row per (device, bucket) of
    mergeable partials -- counts, moments, min/max -- where a bucket is the
    greatest common divisor of size and hop, so no window cuts one.  Only the
    buckets are expanded into the windows that contain them, so the expansion
    does not grow with the event rate.  Streaming
    (``pre_shifted``): events are windowed directly so that the window stays
    on the watermarked column."""
    if pre_shifted:
        return _hopping_direct(tel, size, hop, ts_col, after)
    shifted = F.col(ts_col) - F.expr("INTERVAL 1 MICROSECOND")
    grain = f"{math.gcd(interval_us(size), interval_us(hop))} microseconds"
    buckets = (tel.where(F.col(ts_col).isNotNull())
               .groupBy("device_id", "device_type",
                        F.window(shifted, grain)["start"].alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"),
                    *moment_aggs("temperature_c", "t"),
                    F.max("temperature_c").alias("mx"), F.min("temperature_c").alias("mn"),
                    F.count("pressure_hpa").alias("p_n"), F.sum("pressure_hpa").alias("p_s1"),
                    F.min("battery_pct").alias("mb"),
                    F.sum(F.col("anomaly_flag").cast("long")).alias("an")))
    p_n = F.sum("p_n")
    return (
        buckets.groupBy(F.window("bucket", size, hop).alias("w"), "device_id", "device_type")
        .agg(F.sum("n").alias("event_count"), *merged_aggs("t"),
             F.max("mx").alias("max_temp_c"), F.min("mn").alias("min_temp_c"),
             F.when(p_n > 0, F.sum("p_s1") / p_n).alias("avg_pressure_hpa"),
             F.min("mb").alias("min_battery_pct"), F.sum("an").alias("anomaly_count"))
        .select(F.col("w.end").alias("window_end"), F.col("w.start").alias("window_start"),
                "device_id", "device_type", "event_count",
                merged_mean("t").alias("avg_temp_c"), merged_stddev("t").alias("stddev_temp_c"),
                "max_temp_c", "min_temp_c", "avg_pressure_hpa", "min_battery_pct", "anomaly_count")
    )


def _hopping_direct(tel: DataFrame, size: str, hop: str, ts_col: str, after: str | None = None) -> DataFrame:
    placed = tel.withColumn("w", F.window(ts_col, size, hop))
    if after:
        placed = placed.where(F.col(after).isNull() | (F.col("w.end") > F.col(after)))
    return (
        placed.groupBy("w", "device_id", "device_type")
        .agg(F.count(F.lit(1)).alias("event_count"),
             F.avg("temperature_c").alias("avg_temp_c"),
             F.stddev_samp("temperature_c").alias("stddev_temp_c"),
             F.max("temperature_c").alias("max_temp_c"),
             F.min("temperature_c").alias("min_temp_c"),
             F.avg("pressure_hpa").alias("avg_pressure_hpa"),
             F.min("battery_pct").alias("min_battery_pct"),
             F.sum(F.col("anomaly_flag").cast("long")).alias("anomaly_count"))
        .select(F.col("w.end").alias("window_end"), F.col("w.start").alias("window_start"),
                "device_id", "device_type", "event_count",
                "avg_temp_c", "stddev_temp_c",
                "max_temp_c", "min_temp_c", "avg_pressure_hpa", "min_battery_pct", "anomaly_count")
    )


# Alert thresholds and the detection source label.
TEMP_HIGH_C = 80
TEMP_LOW_C = -20
BATTERY_CRITICAL_PCT = 10
DETECTION_SOURCE = "STREAM_ANALYTICS"


def threshold_alerts(tel: DataFrame) -> DataFrame:
    """Stateless per-event alert filter with a priority-ordered alert type.
    Works unchanged on a streaming DataFrame."""
    flag = F.col("anomaly_flag").cast("long") == 1
    hot = F.col("temperature_c") > TEMP_HIGH_C
    cold = F.col("temperature_c") < TEMP_LOW_C
    low_batt = F.col("battery_pct") < BATTERY_CRITICAL_PCT
    alert_type = (F.when(flag, "MODEL_ALERT").when(hot, "TEMP_HIGH").when(cold, "TEMP_LOW")
                  .when(low_batt, "BATTERY_CRITICAL").otherwise("UNKNOWN"))
    return (tel.where(flag | hot | cold | low_batt)
            .select("event_id", "device_id", "device_type",
                    F.col("timestamp_utc").alias("event_time"),
                    F.col("event_timestamp").alias("detected_at"),
                    "temperature_c", "humidity_pct", "battery_pct", "anomaly_flag",
                    alert_type.alias("alert_type"),
                    F.lit(DETECTION_SOURCE).alias("detection_source")))
