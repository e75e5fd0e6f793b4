import datetime as dt

import pytest

from voltline.plans import inputs as I
from voltline.plans.catalog import _slices
from voltline.streaming import batchlog
from voltline.streaming import replay as R
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _s(x):
    return T0 + dt.timedelta(seconds=x)


@pytest.fixture()
def log(spark, tmp_path):
    # layer, batch, rows, oldest, newest, done, millis
    rows = [("bronze", 0, 5, _s(0), _s(10), _s(1000), 5), ("silver", 0, 5, _s(0), _s(10), _s(1001), 5),
            ("bronze", 1, 4, _s(11), _s(40), _s(1010), 5), ("silver", 1, 9, _s(1), _s(40), _s(1011), 5),
            ("silver", 1, 4, _s(11), _s(40), _s(1012), 5),  # the batch ran again: its last report counts
            ("gold", 3, 2, _s(5), _s(9), _s(1013), 5)]
    path = str(tmp_path / "log")
    for r in rows:  # reports come in separate writes
        spark.createDataFrame([r], batchlog.SCHEMA).write.mode("append").parquet(path)
    return batchlog.read_log(spark, path)


def test_last_report_of_a_batch_counts(log):
    got = {(r.layer, r.n): r.rows for r in log.collect()}
    assert got == {("bronze", 1): 5, ("bronze", 2): 4, ("silver", 1): 5, ("silver", 2): 4, ("gold", 1): 2}


def test_lags_follow_the_feeds_clock(log):
    got = {(r.layer, r.n): r.lag_sec for r in batchlog.layer_lags(log).collect()}
    assert got == {("bronze", 1): 10.0, ("silver", 1): 10.0, ("bronze", 2): 29.0, ("silver", 2): 29.0, ("gold", 1): 35.0}
    sla = {r.layer: (r.actual_sec, r.status, r.batches)
           for r in batchlog.attainment(log, {"bronze": 30, "silver": 48, "gold": 50}).collect()}
    assert sla == {"bronze": (29.0, "red", 2), "silver": (29.0, "amber", 2), "gold": (35.0, "amber", 1)}


def test_reports_reach_the_log_once(spark):
    path = R.replay_logged(spark, _slices(spark, SF_SMALL), I.registry(spark, SF_SMALL), "log-test")
    log = batchlog.read_log(spark, path)
    rows = {r.layer: r.rows for r in log.groupBy("layer").agg({"rows": "sum"}).withColumnRenamed("sum(rows)", "rows").collect()}
    assert rows["bronze"] == I.bronze(spark, SF_SMALL).count()
    assert rows["silver"] == I.silver(spark, SF_SMALL).count()
    assert rows["gold"] > 0 and log.where("millis <= 0 or done_at is null").isEmpty()


def test_empty_log(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], batchlog.SCHEMA).write.parquet(path)
    assert batchlog.attainment(batchlog.read_log(spark, path), {"bronze": 30}).collect() == []


def test_end_that_never_comes_is_an_error(spark, tmp_path):
    with pytest.raises(TimeoutError):
        batchlog.BatchLog(spark, str(tmp_path / "x")).settle("no-such-run", 0.1)
