"""Statistics over arbitrary doubles, and window parameters."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import telemetry_rows
from voltline.functions.stats import merged_aggs, merged_mean, merged_stddev, moment_aggs
from voltline.functions.timefmt import interval_us
from voltline.operators.alerts import alerts_trailing
from voltline.operators.metrics import throughput_series
from voltline.operators.streamsql import hopping_by_device, shift_for_asa, tumbling_by_type


def merged(spark, values):
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(values)], "b int, v double")
    out = df.groupBy("b").agg(*moment_aggs("v", "t")).agg(*merged_aggs("t"))
    return out.select(merged_mean("t").alias("mean"), merged_stddev("t").alias("std")).first()


@pytest.mark.parametrize("values", [
    [0.004, 0.004, 0.003], [20.001, 20.002, 20.003, 20.004], [1e12, 3.0, 4.0, 5.0, 6.0],
    [random.Random(1).gauss(22, 4) for _ in range(500)]])
def test_merged_moments(spark, values):
    got = merged(spark, values)
    assert math.isclose(got.mean, statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(got.std, statistics.stdev(values), rel_tol=1e-6)


def test_odd_readings_do_not_fail(spark):
    rows = [(f"e{i}", "d1", f"2024-01-01T00:00:0{i + 1}+00:00", v, i == 5)
            for i, v in enumerate([1e12, 3e7, float("nan"), float("inf"), float("inf"), 2.0])]
    rows.append(("timeless", "d1", "garbage", 20.0, True))
    tel = telemetry_rows(spark, rows).withColumn("kafka_timestamp", F.col("event_timestamp"))
    assert math.isnan(tumbling_by_type(tel.where("event_timestamp is not null")).first().avg_temperature_c)
    assert hopping_by_device(tel).count() == 5
    # a flagged event without event time is reported
    assert {r.event_id for r in alerts_trailing(tel).collect()} >= {"e5", "timeless"}


def test_intervals():
    assert interval_us("5 minutes") == 300_000_000 and interval_us("1 hour 30 seconds") == 3_630_000_000
    with pytest.raises(ValueError):
        interval_us("soon")


def test_hop_below_a_minute_equals_direct_windows(spark):
    rows = [(f"e{i}", "d1", f"2024-01-01T00:{i // 6:02d}:{i % 6 * 10:02d}+00:00", float(i % 7), False) for i in range(60)]
    tel = telemetry_rows(spark, rows)
    batch = hopping_by_device(tel, "5 minutes", "30 seconds").collect()
    direct = hopping_by_device(shift_for_asa(tel), "5 minutes", "30 seconds", ts_col="asa_ts", pre_shifted=True).collect()
    key = lambda r: (r.window_end, r.event_count, round(r.avg_temp_c, 9))
    assert sorted(map(key, batch)) == sorted(map(key, direct))


def test_series_in_minutes(spark):
    rows = [(f"e{i}", "d1", f"2024-01-01T00:00:{i:02d}+00:00", 1.0, False) for i in range(60)]
    assert throughput_series(telemetry_rows(spark, rows), "1 minute").first().events_per_sec == 1.0
