"""Late rows: what the watermark of a consumer would drop goes to a table.

Spark drops a row from a stateful operator once the row's window has closed,
and only counts it.  A *gate* stands before such a consumer: it applies the
consumer's own rule (newest event time of earlier batches, less the delay) to
each micro-batch and writes every row once, as on time or late, with the
windows that had closed.  The consumer reads the rows on time, and a row is
either in its result or in the late table: kept + late = input, counted in rows
and the windows they belong to.

What a gate has seen is written for each batch, as one number, so a batch that
runs again judges its rows alike.  A batch is staged and appears by one rename
of its folder (on stores without a rename of folders, the copy that stands for
it): a consumer never meets half of it, so its own watermark is never ahead of
the one that let a row pass, and it drops nothing itself.

Defined results: a row without event time belongs to no window and is on time;
before the first event time nothing is late; columns named like the gate's own
(``mark``, ``closed``, ``late``, ``batch_id``) are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.functions.timefmt import interval_us
from voltline.streaming import jobs

OWN = ["mark", "closed", "late", "batch_id"]
JUDGED = [T.StructField("mark", T.TimestampType()), T.StructField("closed", T.ArrayType(T.TimestampType())),
          T.StructField("batch_id", T.LongType()), T.StructField("late", T.BooleanType())]


def _event_time() -> Column:
    return F.col("event_timestamp")


def _asa_time() -> Column:
    return F.col("event_timestamp") - F.expr("INTERVAL 1 MICROSECOND")


def _tumbling_end() -> Column:
    return F.array(F.timestamp_micros((F.floor(F.unix_micros("event_timestamp") / F.lit(300_000_000)) + 1) * 300_000_000))


def _hopping_ends() -> Column:
    first = F.date_trunc("minute", _asa_time())
    return F.sequence(first + F.expr("INTERVAL 1 MINUTE"), first + F.expr("INTERVAL 5 MINUTES"), F.expr("INTERVAL 1 MINUTE"))


def _session_end() -> Column:
    return F.array(F.col("event_timestamp") + F.expr("INTERVAL 5 MINUTES"))


@dataclass(frozen=True)
class Consumer:
    """``time``: the column that carries the watermark; ``closes``: when the
    windows that a row belongs to end; ``takes``: the rows that the consumer reads."""
    delay: str
    time: Callable[[], Column]
    closes: Callable[[], Column]
    takes: str = "true"


# An alert compares a reading with its windows; one that is older than the
# watermark is dropped from the join, so it is late as a whole.
CONSUMERS = {
    "kpis": Consumer(jobs.KPI_WATERMARK, _event_time, _tumbling_end, "is_valid"),
    "hopping": Consumer("1 minute", _asa_time, _hopping_ends),
    "sessions": Consumer("1 minute", _event_time, _session_end),
    "alerts": Consumer(jobs.ALERT_WATERMARK, _event_time, lambda: F.array(F.col("event_timestamp"))),
}


def judge(rows: DataFrame, consumer: Consumer, newest_us: int | None) -> DataFrame:
    """``rows`` with the watermark after event times up to ``newest_us`` (whole
    milliseconds, as Spark keeps it), the windows it has closed, and whether
    these are all of the row's."""
    at = None if newest_us is None else newest_us // 1000 * 1000 - interval_us(consumer.delay)
    mark = F.timestamp_micros(F.lit(at).cast("long"))
    closes = consumer.closes()  # of a row without time: null, or an array of null
    closed = F.coalesce(F.filter(closes, lambda c: c <= mark), F.array().cast("array<timestamp>"))
    return (rows.where(consumer.takes).drop(*OWN).withColumn("mark", mark).withColumn("closed", closed)
            .withColumn("late", (F.size("closed") > 0) & F.coalesce(F.size("closed") == F.size(closes), F.lit(False))))


def _publish(spark: SparkSession, staged: str, target: str) -> None:
    source, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, to):
        raise OSError(f"cannot rename {staged} to {target}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def gate_batch(spark: SparkSession, consumer: Consumer, path: str, marks: str):
    """foreachBatch function.  ``path/batch_id=N/late=...`` gets the rows of
    batch N; ``marks/batch_id=N`` the newest event time up to and with it."""
    def gate(batch: DataFrame, n: int) -> None:
        target, staged = f"{path}/batch_id={n}", f"{path}/_staged-{n}"
        if _exists(spark, target):  # the rename is the batch's commit
            return
        before = spark.read.schema("newest long").parquet(f"{marks}/batch_id={n - 1}").first()[0] if n else None
        judge(batch, consumer, before).write.mode("overwrite").partitionBy("late").parquet(staged)
        written = spark.read.schema(T.StructType([*batch.drop(*OWN).schema.fields, JUDGED[-1]])).parquet(staged)
        newest = F.greatest(F.max(F.unix_micros(consumer.time())), F.lit(before).cast("long"))
        written.agg(newest.alias("newest")).coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch_id={n}")
        _publish(spark, staged, target)
    return gate


def start_gate(rows: DataFrame, consumer: str, path: str, checkpoint: str, available_now: bool = False):
    """Streaming ``rows`` -> the judged table of a consumer (see ``CONSUMERS``)."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.drop(*OWN).schema.fields, *JUDGED])
    jobs.ensure_table(spark, path, schema, ["batch_id", "late"])
    w = (rows.writeStream.foreachBatch(gate_batch(spark, CONSUMERS[consumer], path, f"{checkpoint}-marks"))
         .option("checkpointLocation", checkpoint))
    return jobs._trigger(w, "silver", available_now).start()


def _judged_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.drop(*OWN).schema.fields, *JUDGED])


def on_time(rows: DataFrame, path: str) -> DataFrame:
    """What the gate let pass, as a stream; ``rows``: the gate's input (for its
    columns).  ``mark`` is the watermark that a row has passed: a consumer with
    several windows for a row counts it in those that end after it."""
    return jobs.table_stream(rows.sparkSession, path, _judged_schema(rows)).where(~F.col("late"))


def late_rows(rows: DataFrame, path: str) -> DataFrame:
    """One row for each row and window that had closed (``closed_at``)."""
    table = rows.sparkSession.read.schema(_judged_schema(rows)).parquet(path)
    return table.withColumn("closed_at", F.explode("closed")).drop("closed")
