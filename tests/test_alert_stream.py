"""The alert stream at size: events kept in cells, and the store that keeps them."""

import datetime as dt
from collections import Counter
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from voltline import session
from voltline.operators.alerts import ALERT_INPUT, CELL_PARTS, alerts_stream
from voltline.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("event_id string, device_id string, device_type string, region string, event_timestamp timestamp, "
          "temperature_c double, anomaly_flag boolean")


def _events(n: int, minutes: int = 12, device: str | None = "device-1", name: str = "e") -> list[tuple]:
    """``n`` events spread over ``minutes``: two levels of readings, now and then one far out, a flag or a null."""
    return [(f"{name}{i}", device, "sensor_v2", None if i % 7 == 0 else "EUROPE", T0 + dt.timedelta(seconds=i * 60 * minutes / n),
             None if i % 31 == 0 else 90.0 if i % 97 == 5 else 20.0 + i % 3, None if i % 5 == 0 else i % 41 == 0) for i in range(n)]


def _run(spark, path, rows: list[tuple], ck) -> tuple[list, list]:
    """Lands the rows and runs the stream over the folder to its end; its alerts, and its state operators by batch."""
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{path}/in")
    out = alerts_stream(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"))
    with jobs.stream_partitions(spark):
        q = (out.writeStream.format("parquet").option("checkpointLocation", str(ck)).trigger(availableNow=True).start(f"{path}/out"))
        q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out").collect(), [p["stateOperators"] for p in q.recentProgress if p["stateOperators"]]


def _expected(rows: list[tuple], size: int = 10) -> Counter:
    """(event, window start or None, trigger) by brute force over half-open windows."""
    out = Counter()
    for e, device, _, _, ts, t, flag in rows:
        if ts is None or device is None:  # meets no statistics
            out.update([(e, None, "MODEL")] if flag else [])
            continue
        first = ts.replace(second=0, microsecond=0)
        for k in range(size):
            start = first - dt.timedelta(minutes=k)
            held = [r[5] for r in rows if r[1] == device and r[4] and r[5] is not None and start <= r[4] < start + dt.timedelta(minutes=size)]
            far = t is not None and len(held) > 1 and abs(t - mean(held)) > 3 * stdev(held)
            if flag or far:
                out[(e, start, "BOTH" if flag and far else "MODEL" if flag else "STATISTICAL")] += 1
    return out


SENTINEL = ("sentinel", "device-9", "sensor_v2", "EUROPE", T0 + dt.timedelta(days=2), 20.0, False)


def test_state_and_join_count_cells_of_a_dense_device(spark, tmp_path):
    rows = _events(1200)
    got, ops = _run(spark, tmp_path, [*rows, SENTINEL], tmp_path / "ck")
    assert Counter((r.event_id, r.window_start, r.trigger) for r in got) == _expected(rows)
    held = [o["numRowsTotal"] + o["numRowsUpdated"] for b in ops for o in b if o["operatorName"] == "symmetricHashJoin"]
    # 12 minutes x parts x (with and without region); statistics of 21 windows in at most two buckets
    assert max(held) <= 2 * 12 * 2 * CELL_PARTS and max(held) < len(rows)
    rows_of = {r[0]: r for r in rows}
    assert all(tuple(r[c] for c in ALERT_INPUT if c != "anomaly_flag") == tuple(
        v for c, v in zip(ALERT_INPUT, rows_of[r.event_id], strict=True) if c != "anomaly_flag") for r in got)


def test_null_keys_missing_times_and_repeats(spark, tmp_path):
    rows = [*_events(60), *_events(60, device=None, name="nobody"),
            ("timeless", "device-1", "sensor_v2", "EUROPE", None, 20.0, True), ("timeless-plain", "device-1", None, None, None, 90.0, False),
            *[("twice", "device-2", "sensor_v2", "EUROPE", T0 + dt.timedelta(seconds=30), 20.0, True)] * 2,
            *[(None, "device-2", "sensor_v2", "EUROPE", T0 + dt.timedelta(seconds=30), 20.0, True)] * 2]
    got, _ = _run(spark, tmp_path, [*rows, SENTINEL], tmp_path / "ck")
    assert Counter((r.event_id, r.window_start, r.trigger) for r in got) == _expected(rows)


def test_windows_that_span_batches(spark, tmp_path):
    """Cells and windows that stay open over a restart meet the events that come then."""
    rows = _events(240, minutes=24)
    cut = T0 + dt.timedelta(minutes=11, seconds=20)
    _run(spark, tmp_path, [r for r in rows if r[4] < cut], tmp_path / "ck")
    _run(spark, tmp_path, [r for r in rows if r[4] >= cut], tmp_path / "ck")
    got, _ = _run(spark, tmp_path, [SENTINEL], tmp_path / "ck")
    assert Counter((r.event_id, r.window_start, r.trigger) for r in got) == _expected(rows)


@pytest.fixture
def unnamed_store(spark):
    """A session that names no state store."""
    before = spark.conf.get(session.PROVIDER)
    spark.conf.unset(session.PROVIDER)
    yield
    spark.conf.set(session.PROVIDER, before)


def test_large_tables_keep_events_in_rocksdb(spark, unnamed_store, monkeypatch):
    monkeypatch.delenv("VOLTLINE_STATE_STORE", raising=False)
    large = session.event_state_conf(spark, session.LARGE_TABLE_BYTES)
    assert large[session.PROVIDER] == session.STATE_STORES["rocksdb"]
    assert large["spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"] == "true"
    assert session.event_state_conf(spark, 0) == {session.PROVIDER: session.STATE_STORES["memory"]}
    # executors of their own: always
    monkeypatch.setattr(session, "_context", lambda _: type("Context", (), {"master": "local-cluster[3,2,3000]"}))
    assert session.event_state_conf(spark, 0) == large
    # a store that was named stays
    spark.conf.set(session.PROVIDER, session.STATE_STORES["memory"])
    assert session.event_state_conf(spark, session.LARGE_TABLE_BYTES) == {session.PROVIDER: session.STATE_STORES["memory"]}


def test_alert_job_uses_the_store_and_keeps_it(spark, unnamed_store, monkeypatch, tmp_path):
    monkeypatch.delenv("VOLTLINE_STATE_STORE", raising=False)
    rows = _events(60)

    def run(new):
        (spark.createDataFrame(new, SCHEMA).withColumn("event_date", F.lit(T0.date())).withColumn("batch_id", F.lit(0).cast("long"))
         .write.mode("append").partitionBy("batch_id", "event_date").parquet(f"{tmp_path}/silver"))
        with jobs.stream_partitions(spark):
            q = jobs.start_alerts(spark, f"{tmp_path}/silver", f"{tmp_path}/alerts", f"{tmp_path}/ck", available_now=True)
            q.awaitTermination()
        assert spark.conf.get(session.PROVIDER, None) is None
        return {m for p in q.recentProgress for o in p["stateOperators"] for m in o["customMetrics"]}

    monkeypatch.setattr(session, "LARGE_TABLE_BYTES", 0)
    assert any(m.startswith("rocksdb") for m in run(rows))
    monkeypatch.setattr(session, "LARGE_TABLE_BYTES", 1 << 40)
    assert any(m.startswith("rocksdb") for m in run([SENTINEL]))  # as the checkpoint began
    got = spark.read.parquet(f"{tmp_path}/alerts").collect()
    assert Counter((r.event_id, r.window_start, r.trigger) for r in got) == _expected(rows)
