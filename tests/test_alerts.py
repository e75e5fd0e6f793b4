import datetime as dt
import math
import random
import statistics
import time

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltline.operators.alerts import alerts_range, alerts_trailing, sliding_stats
from tests.conftest import SF_SMALL, telemetry_rows


def _ts(sec):
    return (dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=sec)).isoformat() + "+00:00"


def _burst(n, extreme):
    rows = [(f"e{i}", "d1", _ts(5 + i), 20.0, False) for i in range(n - 1)]
    rows.append((f"e{n - 1}", "d1", _ts(5 + n), extreme, False))
    return rows


def test_three_sigma_needs_eleven_readings(spark):
    # with n readings the largest |z| of a member is (n-1)/sqrt(n): > 3 needs n >= 11
    assert alerts_range(telemetry_rows(spark, _burst(10, 90.0))).count() == 0
    assert alerts_range(telemetry_rows(spark, _burst(11, 90.0))).count() > 0


def test_flag_with_null_stats(spark):
    rows = [("a", "d1", _ts(1), None, True), ("b", "d2", _ts(1), None, False)]
    out = alerts_range(telemetry_rows(spark, rows)).collect()
    assert {r.event_id for r in out} == {"a"}
    assert all(r.rolling_std_temp is None for r in out)


def test_boundary_event_meets_eleven_windows(spark):
    rows = [("a", "d1", _ts(0), 20.0, True), ("b", "d1", _ts(120), 20.0, True),
            ("c", "d1", _ts(61.5), 20.0, True)]
    out = alerts_range(telemetry_rows(spark, rows))
    counts = {r.event_id: r["count"] for r in out.groupBy("event_id").count().collect()}
    assert counts["b"] == 11 and counts["c"] == 10


def test_sliding_stats_match_direct_windows(spark):
    from voltline.plans import inputs as I
    s = I.silver(spark, SF_SMALL)
    mine = sliding_stats(s).select("device_id", "window_start", "rolling_avg_temp")
    direct = (s.where(F.col("event_timestamp").isNotNull())
              .groupBy("device_id", F.window("event_timestamp", "10 minutes", "1 minute").alias("w"))
              .agg(F.avg("temperature_c").alias("rolling_avg_temp"))
              .select("device_id", F.col("w.start").alias("window_start"), "rolling_avg_temp"))
    a, b = sorted(mine.collect()), sorted(direct.collect())
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert all(x[2] == y[2] or abs(x[2] - y[2]) < 1e-9 for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("frame", [600, 47])
def test_trailing_blocks_match_sliding_frame(spark, frame):
    from voltline.plans import inputs as I
    s = I.silver(spark, SF_SMALL)
    mine = alerts_trailing(s, frame).select("event_id", "trailing_n")
    w = (Window.partitionBy("device_id").orderBy(F.unix_micros("event_timestamp"))
         .rangeBetween(-frame * 1_000_000, 0))
    brute = (s.where(F.col("event_timestamp").isNotNull())
             .select("event_id", F.count("temperature_c").over(w).alias("trailing_n")))
    got = dict((r.event_id, r.trailing_n) for r in mine.collect())
    want = dict((r.event_id, r.trailing_n) for r in brute.collect())
    assert got and all(want[k] == v for k, v in got.items())


def test_trailing_frame_edges(spark):
    # ties, readings exactly one frame apart, nulls, a large mean, an event without time
    rng = random.Random(3)
    secs = [0, 0, 600, 600, 1200, 1199.999999, *(rng.randrange(0, 4000) for _ in range(120))]
    rows = [(f"e{i}", "d1", _ts(x), None if i % 13 == 5 else 1e9 + rng.random(), True) for i, x in enumerate(secs)]
    rows.append(("none", "d1", None, 5.0, True))
    rows.append(("quiet", "d1", None, 5.0, False))
    got = {r.event_id: r for r in alerts_trailing(telemetry_rows(spark, rows)).collect()}
    assert set(got) == {r[0] for r in rows} - {"quiet"}
    assert got["none"].trailing_n is None and got["none"].trailing_std_temp is None
    for i, x in enumerate(secs):
        frame = [rows[k][3] for k, y in enumerate(secs) if x - 600 <= y <= x and rows[k][3] is not None]
        r = got[f"e{i}"]
        assert r.trailing_n == len(frame)
        if frame:
            assert math.isclose(r.trailing_avg_temp, statistics.fmean(frame), rel_tol=1e-15)
        if len(frame) > 1:
            assert math.isclose(r.trailing_std_temp, statistics.stdev(frame), rel_tol=1e-6)


def test_trailing_frame_is_linear_on_one_device(spark):
    def seconds(n):
        tel = telemetry_rows(spark, [("x", "d1", _ts(0), 20.0, False)]).drop("event_id", "event_timestamp", "temperature_c")
        rows = (spark.range(n).crossJoin(tel)  # one row on the right
                .select("*", F.col("id").cast("string").alias("event_id"), F.rand(5).alias("temperature_c"),
                        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * F.lit(3_600_000_000 // n))
                        .alias("event_timestamp")))
        start = time.monotonic()
        alerts_trailing(rows).write.format("noop").mode("overwrite").save()
        return time.monotonic() - start

    seconds(10_000)
    small = seconds(100_000)
    assert seconds(400_000) <= 5 * small
