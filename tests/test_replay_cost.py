"""What a replay parses besides its jobs: the sentinel's record and the devices of a Silver batch."""

import datetime as dt
import functools
import json

from voltline.operators import silver
from voltline.operators.bronze import project_bronze
from voltline.operators.joins import broadcast_if_small
from voltline.schemas import KAFKA_SCHEMA, REGISTRY_COLUMNS
from voltline.streaming import jobs, replay

T0 = dt.datetime(2024, 1, 1)
BROKEN = ("{", json.dumps({"device_id": "device-1", "timestamp_utc": "2024-01-01T00:00:00+00:00"}),
          json.dumps({"event_id": "x", "device_id": "device-1", "timestamp_utc": "no time"}))


def _good(i: int) -> str:
    return json.dumps({"event_id": f"e{i}", "device_id": f"device-{i % 3}", "timestamp_utc": f"2024-01-01T00:{i % 60:02d}:00+00:00"})


def _records(spark, values):
    return spark.createDataFrame([(b"k", v.encode(), "t", 0, i, T0) for i, v in enumerate(values)], KAFKA_SCHEMA)


def test_sentinel_parses_the_newest_first_and_all_if_need_be(spark, monkeypatch):
    asked = []

    def seen(records, found=replay._well_formed):
        asked.append(records.count())
        return found(records)

    monkeypatch.setattr(replay, "_well_formed", seen)
    monkeypatch.setattr(replay, "NEWEST", 4)
    for values, expected, looked_at in ((map(_good, range(30)), "e29-sentinel", [4]),
                                        ([*map(_good, range(30)), *BROKEN], "e29-sentinel", [4]),
                                        ([*map(_good, range(30)), *BROKEN, *BROKEN], "e29-sentinel", [4, 36]),
                                        (BROKEN, None, [3, 3])):
        asked.clear()
        rows = replay.sentinel(_records(spark, list(values))).collect()
        got = [json.loads(r["value"]) for r in rows]
        assert [g["event_id"] for g in got] == ([expected] if expected else [])
        assert asked == looked_at
        if got:
            assert rows[0]["offset"] == 30 and rows[0]["timestamp"] == T0 + dt.timedelta(days=365)
            assert got[0]["timestamp_utc"].startswith("2024-12-31T00:29:00")


def test_silver_batch_parses_once_for_the_devices_of_a_large_registry(spark, monkeypatch, tmp_path):
    n = 40
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    project_bronze(_records(spark, map(_good, range(n)))).write.partitionBy("event_date").parquet(bronze)
    registry = spark.createDataFrame([(f"device-{i}", *["x"] * (len(REGISTRY_COLUMNS) - 1)) for i in range(1, 9)], ", ".join(f"{c} string" for c in REGISTRY_COLUMNS))
    monkeypatch.setattr(silver, "broadcast_if_small", functools.partial(broadcast_if_small, max_bytes=300))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    q = jobs.start_silver(spark, bronze, path, registry, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    # the count, the devices and the rows; before, the devices were parsed for the measure and for the join
    assert sum(p["numInputRows"] for p in q.recentProgress) <= 3 * n
    got = {(r.event_id, r.region) for r in spark.read.schema(jobs.SILVER_TABLE_SCHEMA).parquet(path).collect()}
    assert got == {(f"e{i}", None if i % 3 == 0 else "x") for i in range(n)}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
