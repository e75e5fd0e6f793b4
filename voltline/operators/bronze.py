"""Bronze: land every hub record as-is, with envelope and date partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_bronze(records: DataFrame, with_ingest_time: bool = True) -> DataFrame:
    """Kafka-protocol records -> Bronze rows.

    ``event_date`` (the partition column) is the UTC calendar day of the hub
    timestamp, not of the event time.
    """
    cols = [
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]
    if with_ingest_time:
        cols.append(F.current_timestamp().alias("ingested_at"))
    cols.append(F.date_format(F.col("timestamp"), "yyyy-MM-dd").alias("event_date"))
    return records.select(*cols)


def read_bronze(spark, path: str, merge_schema: bool = True):
    """Read a Bronze folder whose files may come from producer versions
    with additive schema changes: ``mergeSchema`` unions the file schemas
    (columns a file lacks read as NULL)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
