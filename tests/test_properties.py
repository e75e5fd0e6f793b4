"""Property tests (hypothesis): upsert idempotence / order independence,
window membership counts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltline.functions.timefmt import asa_window
from voltline.operators.silver import upsert_new_rows

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

deliveries = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50), st.integers(0, 3)),
                      min_size=1, max_size=25)


def _df(spark, rows):
    return spark.createDataFrame([(f"e{e}", off, part, f"v{e}-{off}-{part}") for e, off, part in rows],
                                 "event_id string, kafka_offset long, kafka_partition int, v string")


@SETTINGS
@given(rows=deliveries, split=st.integers(0, 25))
def test_upsert_idempotent_and_order_independent(spark, rows, split):
    a, b = _df(spark, rows[:split]), _df(spark, rows[split:])
    t1 = upsert_new_rows(a, None)
    t1 = t1.unionByName(upsert_new_rows(b, t1))
    # replaying batch b changes nothing
    assert upsert_new_rows(b, t1).count() == 0
    # one row per event whatever the split
    assert sorted(r.event_id for r in t1.collect()) == sorted({f"e{e}" for e, _, _ in rows})
    # in one batch the first delivery (lowest offset, then partition) wins
    once = {r.event_id: (r.kafka_offset, r.kafka_partition) for r in upsert_new_rows(_df(spark, rows), None).collect()}
    for e in {e for e, _, _ in rows}:
        assert once[f"e{e}"] == min((o, p) for x, o, p in rows if x == e)


@SETTINGS
@given(secs=st.lists(st.integers(0, 3600 * 3) | st.integers(0, 180).map(lambda m: m * 60),
                     min_size=1, max_size=20))
def test_each_event_in_one_tumbling_and_five_hopping_windows(spark, secs):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s, microseconds=7 * (s % 3)),) for s in secs],
                               "ts timestamp")
    tumble = df.select(asa_window("ts", "1 minute").alias("w"))
    hop = df.select(asa_window("ts", "5 minutes", "1 minute").alias("w"))
    assert tumble.count() == len(secs)
    assert hop.count() == 5 * len(secs)
    # membership is (start, end]
    rows = df.select("ts", F.explode(F.array(asa_window("ts", "5 minutes", "1 minute"))).alias("w")).collect()
    assert all(r.w.start < r.ts <= r.w.end for r in rows)
