"""Streaming sources: the Kafka-protocol hub, or a folder of hub records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltline.schemas import KAFKA_SCHEMA

# Source options of the hub reader.
HUB_DEFAULTS = {
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
    "maxOffsetsPerTrigger": "500000",
}


def hub_options(spark: SparkSession) -> dict:
    """Kafka source options from ``pipeline.hub.*`` settings of the session
    (bootstrap servers, topic, security settings), over the defaults."""
    opts = dict(HUB_DEFAULTS)
    topic = spark.conf.get("pipeline.hub.topic", "telemetry-events")
    opts["subscribe"] = topic
    servers = spark.conf.get("pipeline.hub.bootstrap", None)
    if servers:
        opts["kafka.bootstrap.servers"] = servers
    for key in ("kafka.security.protocol", "kafka.sasl.mechanism", "kafka.sasl.jaas.config"):
        v = spark.conf.get(f"pipeline.hub.{key}", None)
        if v:
            opts[key] = v
    return opts


def hub_stream(spark: SparkSession) -> DataFrame:
    """Kafka-protocol stream (needs the Kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**hub_options(spark)).load()


def hub_folder_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Hub records landed as Parquet files (same columns as the Kafka
    source); new files are picked up in arrival order."""
    r = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A Parquet table (possibly partitioned) read as a stream of new files."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)
