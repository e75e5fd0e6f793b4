"""The streaming medallion jobs.

Each ``start_*`` function wires one query and returns the StreamingQuery.
Tables are Parquet folders; progress is kept in ``checkpoint`` folders
under the shared checkpoint location so a restarted job resumes where it
stopped and a replayed micro-batch does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.operators import alerts as alert_ops
from voltline.operators import gold, keytable, sessions, streamsql
from voltline.operators.bronze import project_bronze
from voltline.operators.silver import add_quality, enrich, parse_and_validate, silver_upsert_rows
from voltline.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from voltline.session import default_parallelism, event_state_conf
from voltline.streaming.batchlog import observed
from voltline.streaming.sources import table_stream

# Trigger intervals and watermarks of the jobs.
TRIGGERS = {"bronze": "10 seconds", "silver": "30 seconds", "gold_kpis": "1 minute",
            "alerts": "30 seconds"}
KPI_WATERMARK = "2 minutes"
ALERT_WATERMARK = "1 minute"
DEDUP_DELAY = "1 hour"  # how much later, by hub time, a second delivery may come

# Partition columns last, as Spark orders them once the folder holds partitions: a
# stream that starts on the empty table keeps the order of this schema.
SILVER_TABLE_SCHEMA = T.StructType([f for f in SILVER_SCHEMA.fields if f.name != "event_date"]
                                   + [T.StructField("batch_id", T.LongType()), SILVER_SCHEMA["event_date"]])


@contextmanager
def stream_partitions(spark: SparkSession):
    """Shuffle (= state store) partitions for streaming queries started in
    this block.  A streaming query fixes this number in its checkpoint at
    first start, so it is sized for the source -- ``pipeline.stream.partitions``,
    else the cluster's default parallelism -- instead of inheriting a batch
    setting.  The session value is restored afterwards."""
    wanted = spark.conf.get("pipeline.stream.partitions", None) \
        or str(default_parallelism(spark))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    try:
        yield int(wanted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def event_state(spark: SparkSession, table: str):
    """State store settings for a query started in this block that holds the
    events of ``table`` in state.  A checkpoint keeps the store it began with."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    held = fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0
    conf = event_state_conf(spark, held)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _trigger(writer, name: str, available_now: bool):
    return writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=TRIGGERS[name])


def start_bronze(records: DataFrame, bronze_path: str, checkpoint: str,
                 available_now: bool = False, extra: dict[str, Column] | None = None):
    """Hub records -> Bronze, appended and partitioned by hub date.  ``extra``:
    columns that a later version of the job adds; it resumes from the same
    checkpoint, and files of both versions are one table (``mergeSchema``)."""
    # a file sink writes literals as required columns, which older files lack: tie them to a nullable one
    added = {c: F.when(F.col("kafka_timestamp").isNotNull(), x) for c, x in (extra or {}).items()}
    rows = observed(project_bronze(records).withColumns(added), "bronze", "kafka_timestamp", "kafka_timestamp")
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("event_date"))
    return _trigger(w, "bronze", available_now).start(bronze_path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str]):
    """Create an empty table with a fixed schema so readers can start
    before the first writer batch lands."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):  # in any store that Spark reads
        return
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def target_keys(spark: SparkSession, silver_path: str, batch_id: int) -> DataFrame:
    """event_ids already in Silver, excluding micro-batch ``batch_id``.  Only
    the key column is read; the whole key history counts."""
    return (spark.read.schema(SILVER_TABLE_SCHEMA).parquet(silver_path)
            .where(F.col("batch_id") != F.lit(batch_id)).select("event_id"))


# A batch's tasks sort what they read by key and by output folder, in several times the bytes shuffled.
ROWS_PER_PARTITION, TASK_SHUFFLE_BYTES = 50_000, "32m"


@contextmanager
def batch_partitions(batch_df: DataFrame):
    """Shuffle partitions of a micro-batch by its own rows, for as long as it is
    worked on.  The job keeps no state, so the number that its query started
    with, which suits small batches, binds nothing; AQE joins small partitions."""
    spark = batch_df.sparkSession
    key, most = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, bytes_before = spark.conf.get(key), spark.conf.get(most)
    spark.conf.set(key, str(max(int(before), -(-batch_df.count() // ROWS_PER_PARTITION))))
    spark.conf.set(most, TASK_SHUFFLE_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)
        spark.conf.set(most, bytes_before)


Registry = DataFrame | Callable[[], DataFrame]


def _landed(spark: SparkSession, marker: str) -> bool:
    try:
        return not spark.read.parquet(marker).isEmpty()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def silver_upsert_batch(spark: SparkSession, silver_path: str, registry: Registry, landed: str | None = None,
                        keys: str | None = None):
    """foreachBatch function: parse + validate + flag + enrich the batch,
    drop in-batch duplicates, insert only event_ids the table does not hold.

    ``registry``: a table, or a function that reads it; the function is called
    for each micro-batch, so a snapshot that was replaced in the meantime is
    seen by the next batch.

    The batch lands in ``batch_id=N`` with dynamic partition overwrite, and
    the anti-join reads every batch except N: a replayed batch rewrites its
    own output instead of adding to it.

    ``landed``: folder for a mark of every batch that is complete.  A replay
    of a marked batch keeps its files, so a stream that has read them does not
    meet them again under new names.  Only a failure between the table's write
    and the mark still rewrites files (``start_silver_sink`` has no such gap).

    ``keys``: folder of a key table; a batch then reads the buckets of its own
    keys instead of the whole key history."""
    def upsert(batch_df: DataFrame, batch_id: int) -> None:
        marker = f"{landed}/batch_id={batch_id}"
        if landed and _landed(spark, marker):
            return
        # a large registry is cut to the batch's devices, measured and then joined: the payloads are parsed for them once
        met = parse_and_validate(batch_df).select("device_id").distinct().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with batch_partitions(batch_df):
                write(batch_df, batch_id, met)
        finally:
            met.unpersist()
        if landed:
            spark.range(1).write.mode("overwrite").parquet(marker)

    def write(batch_df: DataFrame, batch_id: int, met: DataFrame) -> None:
        devices = registry() if callable(registry) else registry
        if keys:
            ensure_table(spark, keys, T._parse_datatype_string(keytable.SCHEMA), ["bucket", "batch_id"])
            held = keytable.known_keys(spark, keys, parse_and_validate(batch_df).select("event_id"), batch_id)
        else:
            held = target_keys(spark, silver_path, batch_id)
        fresh = (silver_upsert_rows(batch_df, devices, held, devices=met)
                 .withColumn("batch_id", F.lit(batch_id).cast("long")))
        (fresh.select(*SILVER_TABLE_SCHEMA.fieldNames()).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "event_date").parquet(silver_path))
        if keys:
            written = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(silver_path).where(F.col("batch_id") == F.lit(batch_id))
            keytable.write_keys(written, keys, batch_id)
    return upsert


def start_silver(spark: SparkSession, bronze_path: str, silver_path: str, registry: Registry,
                 checkpoint: str, available_now: bool = False):
    """Bronze table (as a stream) -> Silver via foreachBatch upsert."""
    ensure_table(spark, silver_path, SILVER_TABLE_SCHEMA, ["batch_id", "event_date"])
    bronze = table_stream(spark, bronze_path, BRONZE_SCHEMA)
    # marks go with the checkpoint: a new checkpoint numbers its batches anew
    fn = silver_upsert_batch(spark, silver_path, registry, f"{checkpoint}-landed")
    w = (bronze.writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, "silver", available_now).start()


def start_silver_sink(spark: SparkSession, bronze_path: str, silver_path: str, registry: DataFrame,
                      checkpoint: str, available_now: bool = False, max_files: int | None = None,
                      delay: str = DEDUP_DELAY):
    """Bronze table (as a stream) -> Silver as an exactly-once file sink.

    Duplicates are dropped in the stream: an event_id is kept in state until the
    hub time has passed it by ``delay``, so state is bounded by the rate times
    the delay.  The sink lists the files of each batch in its own log; what a
    failed attempt wrote is not listed, so neither batch nor stream readers
    (Gold) ever see it, and a replayed batch lists its files once."""
    rows = (parse_and_validate(table_stream(spark, bronze_path, BRONZE_SCHEMA, max_files))
            .withWatermark("kafka_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"]))
    silver = enrich(add_quality(rows), registry)
    silver = observed(silver.select(*SILVER_SCHEMA.fieldNames()), "silver", "kafka_timestamp", "kafka_timestamp")
    w = (silver.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("event_date"))
    return _trigger(w, "silver", available_now).start(silver_path)


def silver_stream(spark: SparkSession, silver_path: str) -> DataFrame:
    return table_stream(spark, silver_path, SILVER_TABLE_SCHEMA)


def start_gold_kpis(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
                    available_now: bool = False, silver: DataFrame | None = None):
    """Silver stream -> 5-minute KPIs, emitted once the watermark passes the
    window end; partitioned by region.  ``silver``: a stream to read instead of
    the table, such as what a lateness gate let pass."""
    rows = silver_stream(spark, silver_path) if silver is None else silver
    s = rows.withWatermark("event_timestamp", KPI_WATERMARK)
    kpis = gold.with_written_at(gold.device_kpis(s, distinct_firmware="set"))
    w = (observed(kpis, "gold", "window_end", "window_end").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("region"))
    return _trigger(w, "gold_kpis", available_now).start(gold_path)


def start_alerts(spark: SparkSession, silver_path: str, alerts_path: str, checkpoint: str,
                 available_now: bool = False, silver: DataFrame | None = None):
    """Silver stream -> model / 3-sigma alerts (stream-stream join)."""
    s = silver_stream(spark, silver_path) if silver is None else silver
    out = alert_ops.alerts_stream(s, watermark=ALERT_WATERMARK) \
        .withColumn("alert_raised_at", F.current_timestamp())
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    with event_state(spark, silver_path):
        return _trigger(w, "alerts", available_now).start(alerts_path)


def telemetry_from_hub(records: DataFrame) -> DataFrame:
    """Hub records -> typed telemetry (stream-SQL input, no dedup)."""
    return parse_and_validate(project_bronze(records))


def start_threshold_alerts(records: DataFrame, path: str, checkpoint: str,
                           available_now: bool = False):
    out = streamsql.threshold_alerts(telemetry_from_hub(records))
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _trigger(w, "alerts", available_now).start(path)


def start_sessions(records: DataFrame, path: str, checkpoint: str, watermark: str = "1 minute",
                   available_now: bool = False):
    tel = telemetry_from_hub(records).withWatermark("event_timestamp", watermark)
    out = sessions.device_sessions_stream(tel)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _trigger(w, "alerts", available_now).start(path)
