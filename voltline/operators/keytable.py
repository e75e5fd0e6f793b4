"""Key table of an insert-only target: which keys it holds, by hash bucket.

The table has one folder for each hash bucket of the key and, inside, one for
each micro-batch; files are sorted by key and carry Parquet Bloom filters.  A
batch reads only the buckets that its own keys fall into.  A batch of at most
``FEW_KEYS`` keys also pushes them into the scan, where row groups whose Bloom
filter holds none of them are skipped.  Buckets do not depend on time, so a
duplicate of any age is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
FEW_KEYS = 500
SCHEMA = "event_id string, bucket int, batch_id long"


def key_bucket(key: str = "event_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keys(rows: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Adds the keys of micro-batch ``batch_id``; written again, it replaces itself."""
    (rows.select("event_id", key_bucket(buckets=buckets).alias("bucket"), F.lit(batch_id).cast("long").alias("batch_id"))
     .repartition("bucket").sortWithinPartitions("bucket", "event_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#event_id", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("bucket", "batch_id").parquet(path))


def known_keys(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> DataFrame:
    """event_ids that the table may share with ``batch`` (event_id), without
    those of ``batch_id`` itself.  The driver gets a row for each bucket, and
    the keys where they are few."""
    met = batch.groupBy(key_bucket(buckets=buckets).alias("bucket")).agg(
        F.approx_count_distinct("event_id").alias("n")).collect()
    keys = (spark.read.schema(SCHEMA).parquet(path)
            .where(F.col("bucket").isin([r.bucket for r in met]) & (F.col("batch_id") != F.lit(batch_id))))
    if sum(r.n for r in met) <= FEW_KEYS:
        # one more than the bound tells whether the estimate held
        few = [r.event_id for r in batch.select("event_id").distinct().limit(2 * FEW_KEYS + 1).collect()]
        if len(few) <= 2 * FEW_KEYS:
            keys = keys.where(F.col("event_id").isin(few))
    return keys.select("event_id")
