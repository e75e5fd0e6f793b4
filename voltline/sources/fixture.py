"""Deterministic mapping of the ``events`` table onto device telemetry.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props) is turned into the telemetry contract with integer / IEEE-double
expressions only, so an independent SQL engine computes identical values.
Thirty days of events are compressed into six hours so that 1-10 minute
device windows hold enough readings for windowed statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.functions.timefmt import format_iso_utc

# Fixed values of the mapping.
EPOCH_2024_MICROS = 1704067200000000   # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 120                 # 30 days -> 6 hours
N_DEVICES = 25                         # device number = user_id % 25
DEVICE_BASE = 1000                     # device-1000 ... device-1024
DEVICE_TYPES = ["sensor_v2", "gateway_v3", "actuator_v1", "edge_compute"]
FIRMWARE_VERSIONS = ["2.4.1", "2.4.2", "2.5.0"]
TOPIC = "telemetry-events"
HUB_PARTITIONS = 32
MALFORMED_EVERY = 97                   # event_id % 97 = 0 -> broken JSON text
DUPLICATE_EVERY = 20                   # event_id % 20 = 0 -> delivered twice
DUPLICATE_OFFSET = 1 << 40             # added to the offset of the second delivery


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def telemetry(events: DataFrame) -> DataFrame:
    """Typed telemetry columns plus the hub envelope of each event.

    Output: event_id, device_id, device_type, timestamp_utc, latitude,
    longitude, temperature_c, humidity_pct, pressure_hpa, battery_pct,
    firmware_version, anomaly_flag, payload, event_timestamp, kafka_key,
    kafka_partition, kafka_offset, kafka_timestamp, event_date.
    """
    eid = F.col("event_id")
    dn = F.col("user_id") % N_DEVICES
    k = F.get_json_object("props", "$.k").cast("int")
    since = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                             F.col("ts"))
    ev_us = F.lit(EPOCH_2024_MICROS) + F.expr(f"since div {TIME_COMPRESSION}")
    kafka_us = F.col("_ev_us") + (eid % 90) * 1_000_000
    return (
        events
        .select("event_id", "user_id", "event_type", "value",
                dn.alias("_dn"), k.alias("_k"), since.alias("since"))
        .withColumn("_ev_us", ev_us)
        .select(
            F.concat(F.lit("evt-"), eid.cast("string")).alias("event_id"),
            F.concat(F.lit("device-"), (F.col("_dn") + DEVICE_BASE).cast("string")).alias("device_id"),
            _pick(F.col("_dn") % 4, DEVICE_TYPES).alias("device_type"),
            format_iso_utc(F.timestamp_micros("_ev_us")).alias("timestamp_utc"),
            (F.lit(51.4) + (F.col("user_id") % 200) * F.lit(0.2)).alias("latitude"),
            (F.lit(-0.2) + (F.col("user_id") % 150) * F.lit(0.1)).alias("longitude"),
            (F.col("value") - F.lit(30)).alias("temperature_c"),
            (F.col("_k") * F.lit(1.05) - F.lit(1)).alias("humidity_pct"),
            (F.lit(1013.25) + (F.col("_k") - 50) * F.lit(0.1)).alias("pressure_hpa"),
            F.when(eid % 50 == 0, F.lit(None).cast("double"))
             .otherwise(F.col("_k").cast("double")).alias("battery_pct"),
            _pick(eid % 3, FIRMWARE_VERSIONS).alias("firmware_version"),
            ((F.col("event_type") == "error") & (eid % 10 == 0)).alias("anomaly_flag"),
            F.create_map(F.lit("seq"), eid.cast("string")).alias("payload"),
            F.timestamp_micros("_ev_us").alias("event_timestamp"),
            F.concat(F.lit("device-"), (F.col("_dn") + DEVICE_BASE).cast("string")).alias("kafka_key"),
            (F.col("_dn") % HUB_PARTITIONS).cast("int").alias("kafka_partition"),
            eid.alias("kafka_offset"),
            F.timestamp_micros(kafka_us).alias("kafka_timestamp"),
            F.date_format(F.timestamp_micros(kafka_us), "yyyy-MM-dd").alias("event_date"),
        )
    )


PAYLOAD_FIELDS = ["event_id", "device_id", "device_type", "timestamp_utc", "latitude",
                  "longitude", "temperature_c", "humidity_pct", "pressure_hpa",
                  "battery_pct", "firmware_version", "anomaly_flag", "payload"]


def kafka_records(events: DataFrame, timeless_every: int | None = None) -> DataFrame:
    """Kafka-protocol records (key, value, topic, partition, offset,
    timestamp) as the hub would deliver them, including broken JSON text and
    a second delivery of some events (at-least-once).  ``timeless_every``:
    events with such an id carry a text that is no time."""
    # spread over tasks by offset, as a hub source would deliver its partitions
    t = telemetry(events).repartition("kafka_offset")
    eid = F.col("kafka_offset")
    if timeless_every:
        t = t.withColumn("timestamp_utc", F.when(eid % timeless_every == 0, "no time").otherwise(F.col("timestamp_utc")))
    good = F.to_json(F.struct(*PAYLOAD_FIELDS))
    broken = F.concat(F.lit('{"event_id": "'), F.col("event_id"), F.lit('", "device_id": '))
    value = F.when(eid % MALFORMED_EVERY == 0, broken).otherwise(good)
    first = t.select(
        F.col("kafka_key").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
    again = (first.where(F.col("offset") % DUPLICATE_EVERY == 0)
             .withColumn("offset", F.col("offset") + DUPLICATE_OFFSET))
    return first.unionByName(again)


def device_registry(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Device registry snapshot: one device per customer.

    device_id = device-(1000 + c_custkey); site_name = c_name; region = r_name;
    owner_team = n_name; sla_tier = c_mktsegment.
    """
    return (
        customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        .join(nation.select("n_nationkey", "n_name", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region.select("r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("device-"), (F.col("c_custkey") + DEVICE_BASE).cast("string")).alias("device_id"),
            F.col("c_name").alias("site_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("owner_team"),
            F.col("c_mktsegment").alias("sla_tier"),
        )
    )
