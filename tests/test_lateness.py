import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from voltline.plans import inputs as I
from voltline.plans.catalog import _slices
from voltline.streaming import jobs, lateness
from voltline.streaming import replay as R

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
US0 = int(T0.timestamp()) * 1_000_000
SCHEMA = "event_id string, event_timestamp timestamp, is_valid boolean"


def _rows(spark, *rows):
    return spark.createDataFrame(
        [(e, None if s is None else T0 + dt.timedelta(seconds=s), v) for e, s, v in rows], SCHEMA)


def _judged(spark, consumer, newest_s, *rows):
    newest = None if newest_s is None else US0 + round(newest_s * 1_000_000)
    got = lateness.judge(_rows(spark, *rows), lateness.CONSUMERS[consumer], newest).collect()
    return {r.event_id: (r.late, len(r.closed)) for r in got}


def test_nothing_is_late_before_the_first_event_time(spark):
    assert _judged(spark, "kpis", None, ("a", 1, True), ("b", None, True)) == {"a": (False, 0), "b": (False, 0)}


def test_window_that_ends_at_the_watermark_is_closed(spark):
    # watermark 300 s: the window [0, 300) is closed, [300, 600) is open; invalid rows are not the consumer's
    got = _judged(spark, "kpis", 420, ("a", 299.999999, True), ("b", 300, True), ("c", None, True), ("d", 1, False))
    assert got == {"a": (True, 1), "b": (False, 0), "c": (False, 0)}
    # the watermark is kept in whole milliseconds
    assert _judged(spark, "kpis", 419.999999, ("a", 0, True)) == {"a": (False, 0)}


def test_row_late_for_some_of_its_windows(spark):
    # windows (start, end] of 5 minutes each minute; watermark 300 s
    got = _judged(spark, "hopping", 360, ("first", 60, True), ("some", 120, True), ("none", 300.5, True), ("all", 0, True))
    assert got == {"first": (True, 5), "some": (False, 4), "none": (False, 0), "all": (True, 5)}


def test_session_and_alert_rows(spark):
    assert _judged(spark, "sessions", 400, ("a", 40, True), ("b", 41, True)) == {"a": (True, 1), "b": (False, 0)}
    assert _judged(spark, "alerts", 400, ("a", 340, True), ("b", 341, True)) == {"a": (True, 1), "b": (False, 0)}


def test_batch_that_runs_again(spark, tmp_path):
    c, path, marks = lateness.CONSUMERS["kpis"], str(tmp_path / "judged"), str(tmp_path / "marks")
    schema = T.StructType([*_rows(spark).schema.fields, *lateness.JUDGED])
    jobs.ensure_table(spark, path, schema, ["batch_id", "late"])
    gate = lateness.gate_batch(spark, c, path, marks)
    gate(_rows(spark, ("a", 1000, True)), 0)
    one = _rows(spark, ("b", 10, True), ("c", 2000, True))
    # dies after the rows are staged and the mark is written, before the rename
    publish, lateness._publish = lateness._publish, lambda *a: (_ for _ in ()).throw(OSError("lost"))
    try:
        with pytest.raises(OSError):
            gate(one, 1)
    finally:
        lateness._publish = publish
    read = lambda: spark.read.schema(schema).parquet(path)
    assert read().count() == 1  # no reader sees half a batch
    gate(one, 1)
    gate(one, 1)  # a batch that has landed is left alone
    gate(_rows(spark), 2)  # an empty batch keeps the mark
    gate(_rows(spark, ("d", 1801, True)), 3)
    got = {r.event_id: (r.batch_id, r.late) for r in read().collect()}
    assert got == {"a": (0, False), "b": (1, True), "c": (1, False), "d": (3, False)}
    gate(_rows(spark, ("e", 1499, True)), 4)
    assert {r.event_id for r in read().where("late").collect()} == {"b", "e"}


def test_columns_with_the_gates_names_are_replaced(spark):
    rows = _rows(spark, ("a", 1, True)).withColumns({"late": F.lit("x"), "mark": F.lit(1)})
    got = lateness.judge(rows, lateness.CONSUMERS["kpis"], None)
    assert got.columns == ["event_id", "event_timestamp", "is_valid", "mark", "closed", "late"]
    assert got.first().late is False


def test_kept_and_late_are_the_input(spark):
    slices = _slices(spark, SF_SMALL, held_every=I.HELD_EVERY)
    consumers = {"kpis": ("event_count", 1), "hopping": ("event_count", 5), "sessions": ("events_in_session", 1)}
    g = R.replay_gated(spark, slices, I.registry(spark, SF_SMALL), "late-test", list(consumers))
    assert g.dropped == 0  # what a gate lets pass, the consumer's own watermark never drops
    inputs = {"kpis": I.silver(spark, SF_SMALL).where("is_valid").count(), "hopping": I.feed(spark, SF_SMALL).count()}
    inputs["sessions"] = inputs["hopping"]
    for c, (n, windows) in consumers.items():
        kept = spark.read.parquet(g.result(c)).agg(F.sum(n)).first()[0]
        late = g.late(c).count()
        assert late > 0 and kept + late == windows * inputs[c], c


def test_stream_that_starts_on_the_empty_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "silver")
    jobs.ensure_table(spark, path, jobs.SILVER_TABLE_SCHEMA, ["batch_id", "event_date"])
    stream = jobs.silver_stream(spark, path)  # before anything lands
    rows = I.silver(spark, SF_SMALL).withColumn("batch_id", F.lit(0).cast("long")).withColumn("ingested_at", F.col("kafka_timestamp"))
    rows.select(*jobs.SILVER_TABLE_SCHEMA.fieldNames()).write.mode("append").partitionBy("batch_id", "event_date").parquet(path)
    out = str(tmp_path / "out")
    q = (stream.select("event_id", "is_valid", "region", "event_date", "batch_id").writeStream.format("parquet")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out))
    q.awaitTermination()
    key = ["event_id", "is_valid", "region", "event_date", "batch_id"]
    assert sorted(map(tuple, spark.read.parquet(out).select(*key).collect())) == sorted(map(tuple, rows.select(*key).collect()))
