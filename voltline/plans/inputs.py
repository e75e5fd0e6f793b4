"""Shared inputs of the catalog queries, derived from the driver tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.operators.bronze import project_bronze
from voltline.operators.silver import parse_and_validate, silver_upsert_rows
from voltline.session import default_parallelism
from voltline.sources import fixture
from voltline.sources.tables import load_table

SILVER_SCALAR = ["kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp", "event_date",
                 "event_id", "device_id", "device_type", "timestamp_utc", "latitude", "longitude",
                 "temperature_c", "humidity_pct", "pressure_hpa", "battery_pct",
                 "firmware_version", "anomaly_flag", "event_timestamp"]

# Fixed value: boundary between the two upsert batches of ``silver_upsert``.
UPSERT_SPLIT = _dt.datetime(2024, 1, 1, 3, 0, 0)
# Fixed value: every such event of ``alerts_stream_left`` carries no event time.
TIMELESS_EVERY = 11
# Every such event of the ``late_*`` and ``*_gated`` queries reaches the hub so many hours late.
HELD_EVERY, HELD_HOURS = 13, 2
# Fixed value: events for each task of ``tasks``.
ROWS_PER_TASK = 100_000
# Fixed value: run date of the retention plan.
RETENTION_AS_OF = _dt.date(2024, 4, 1)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "events")


def tasks(spark: SparkSession, sf: str) -> int:
    """Tasks for a step that sorts every event whole; the count is read from the file footers."""
    return max(default_parallelism(spark), -(-events(spark, sf).count() // ROWS_PER_TASK))


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Typed telemetry, before it is sent to the hub."""
    return fixture.telemetry(events(spark, sf))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.device_registry(load_table(spark, sf, "customer"),
                                   load_table(spark, sf, "nation"),
                                   load_table(spark, sf, "region"))


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """device_id of every device that sends."""
    return telemetry(spark, sf).select("device_id").distinct()


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as the jobs build it: Bronze payloads parsed, validated,
    de-duplicated, flagged and enriched."""
    return silver_upsert_rows(bronze(spark, sf), registry(spark, sf), None, devices=devices(spark, sf))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream-SQL query reads: every well-formed delivery, parsed."""
    return parse_and_validate(bronze(spark, sf))


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return project_bronze(fixture.kafka_records(events(spark, sf)), with_ingest_time=False)


def flags_text():
    return F.array_join("quality_flags", ",")
