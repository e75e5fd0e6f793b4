"""A log of the pipeline's own micro-batches: one row for each batch and layer.

The jobs observe the rows that a batch adds to their layer (Spark's
``observe``); a query listener turns each progress report into a row and
appends the rows to a Parquet table.  A batch that runs again after a failure
is logged again; readers keep the last report of each (layer, batch).
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "layer string, batch_id long, rows long, oldest timestamp, newest timestamp, done_at timestamp, millis long"
FLUSH_ROWS = 200  # reports held on the driver between two writes
PREFIX = "layer:"


def observed(df: DataFrame, layer: str, first: str, last: str) -> DataFrame:
    """``df`` unchanged; each batch reports its rows, its smallest ``first`` and
    its largest ``last``."""
    return df.observe(PREFIX + layer, F.count(F.lit(1)).alias("rows"), F.min(F.unix_micros(first)).alias("oldest"),
                      F.max(F.unix_micros(last)).alias("newest"))


def _time(us: int | None) -> dt.datetime | None:
    return None if us is None else dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=us)


class BatchLog(StreamingQueryListener):
    """Listens to the queries of a session; ``flush`` writes what was reported.

    ``settle(run_id)`` waits until a query's last report has arrived: reports
    come from another thread, and the end of the query is the last of them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Condition(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = int(p.durationMs.get("triggerExecution", 0))
        done = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")) + dt.timedelta(milliseconds=took)
        with self.lock:
            for name, m in p.observedMetrics.items():
                if name.startswith(PREFIX) and m["rows"]:
                    self.rows.append((name[len(PREFIX):], p.batchId, m["rows"], _time(m["oldest"]), _time(m["newest"]),
                                      done, took))
            full = len(self.rows) >= FLUSH_ROWS
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.runId))
            self.lock.notify_all()

    def settle(self, run_id: str, seconds: float = 60) -> None:
        with self.lock:
            if not self.lock.wait_for(lambda: str(run_id) in self.ended, seconds):
                raise TimeoutError(f"no end reported for query run {run_id}")

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each batch, and ``n``: its number within the layer."""
    last = (spark.read.schema(SCHEMA).parquet(path).groupBy("layer", "batch_id")
            .agg(F.max_by(F.struct("rows", "oldest", "newest", "done_at", "millis"), "done_at").alias("r"))
            .select("layer", "batch_id", "r.*"))
    return last.withColumn("n", F.row_number().over(Window.partitionBy("layer").orderBy("batch_id")))


def layer_lags(log: DataFrame) -> DataFrame:
    """For each batch, how old its oldest row was when the layer got it: the
    newest hub time that Bronze had seen by then, minus the row's time (for
    Gold, the end of its window).

    The clock is the feed's own, so a replay of old data measures the same lags
    as the day itself.  One row a batch travels, some thousands a day."""
    by_time = Window.orderBy("done_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clock = F.max(F.when(F.col("layer") == "bronze", F.col("newest"))).over(by_time)
    lag = (F.unix_micros(clock) - F.unix_micros("oldest")) / F.lit(1_000_000.0)
    return log.select("layer", "n", "rows", lag.alias("lag_sec"))


def attainment(log: DataFrame, targets: dict[str, int]) -> DataFrame:
    """The worst measured lag of each layer against its target (seconds):
    < 60 % green, < 85 % amber, else red."""
    target = F.create_map(*(x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))))
    worst = layer_lags(log).groupBy("layer").agg(F.max("lag_sec").alias("actual_sec"), F.count(F.lit(1)).alias("batches"))
    pct = F.least(F.lit(100.0), F.col("actual_sec") / F.col("target_sec") * F.lit(100.0))
    return (worst.withColumn("target_sec", target[F.col("layer")]).withColumn("pct", pct)
            .withColumn("status", F.when(F.col("pct") < 60, "green").when(F.col("pct") < 85, "amber").otherwise("red")))
