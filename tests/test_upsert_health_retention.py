import datetime as dt

from pyspark.sql import functions as F

from voltline.operators.health import rollup, rollup_all, summary
from voltline.operators.maintenance import interleave_bits, retention_plan
from voltline.operators.silver import dedup_batch, upsert_new_rows


def _batch(spark, rows):
    return spark.createDataFrame(rows, "event_id string, kafka_offset long, kafka_partition int, v string")


def test_dedup_keeps_first_delivery(spark):
    b = _batch(spark, [("e1", 5, 0, "late"), ("e1", 3, 1, "first"), ("e2", 9, 0, "x")])
    got = {r.event_id: r.v for r in dedup_batch(b).collect()}
    assert got == {"e1": "first", "e2": "x"}


def test_upsert_against_target_and_replay(spark):
    target = _batch(spark, [("e1", 1, 0, "old")])
    b = _batch(spark, [("e1", 7, 0, "again"), ("e2", 8, 0, "new"), ("e2", 9, 0, "dup")])
    fresh = upsert_new_rows(b, target).collect()
    assert [(r.event_id, r.v) for r in fresh] == [("e2", "new")]
    # replaying the same batch against a table that now holds it adds nothing
    table = target.unionByName(upsert_new_rows(b, target))
    assert upsert_new_rows(b, table).count() == 0


def test_health_rollup_rules(spark):
    schema = "environment string, name string, status string"
    empty = spark.createDataFrame([], schema)
    assert rollup_all(empty).first().overall_status == "UNKNOWN"
    one_unknown = spark.createDataFrame([("p", "a", "healthy"), ("p", "b", "unknown")], schema)
    assert rollup(one_unknown).first().overall_status == "DEGRADED"
    mixed = spark.createDataFrame([("p", "a", "critical"), ("p", "b", "degraded")], schema)
    assert rollup(mixed).first().overall_status == "CRITICAL"
    s = summary(mixed).first()
    assert (s.healthy, s.degraded, s.critical, s.unknown) == (0, 1, 1, 0)


def test_retention_tiers(spark):
    as_of = dt.date(2024, 4, 1)
    ages = [7, 8, 30, 31, 90, 91]
    parts = spark.createDataFrame([(as_of - dt.timedelta(days=a), 1) for a in ages],
                                  "partition_date date, rows long")
    got = {r.age_days: r.tier for r in retention_plan(parts, as_of).where("layer = 'bronze'").collect()}
    assert [got[a] for a in ages] == ["hot", "cool", "cool", "archive", "archive", "delete"]


def test_interleave_bits(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "a int, b int")
    got = [r[0] for r in df.select(interleave_bits(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [0b0101, 0b1010, 0b0110]
