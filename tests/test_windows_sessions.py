import datetime as dt
import random

from pyspark.sql import functions as F

from voltline.functions.timefmt import asa_window
from voltline.operators.sessions import device_sessions, sessionize
from tests.conftest import telemetry_rows


def test_window_edges(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 1, 0),)], "ts timestamp")
    spark_w = df.select(F.window("ts", "1 minute").alias("w")).first().w
    asa_w = df.select(asa_window("ts", "1 minute").alias("w")).first().w
    assert (spark_w.start.minute, spark_w.end.minute) == (1, 2)     # [00:01, 00:02)
    assert (asa_w.start.minute, asa_w.end.minute) == (0, 1)         # (00:00, 00:01]


def test_session_edges(spark):
    rows = [("a", "d1", "2024-01-01T00:00:00+00:00", 20, False),
            ("b", "d1", "2024-01-01T00:05:00+00:00", 20, False),     # exactly 5 min later
            ("c", "d2", "2024-01-01T00:00:00.900000+00:00", 20, False),
            ("d", "d2", "2024-01-01T00:00:01.100000+00:00", 20, False)]
    out = {r.device_id: r for r in device_sessions(telemetry_rows(spark, rows)).collect()}
    assert out["d1"].events_in_session == 2 and out["d1"].session_duration_sec == 300
    assert out["d2"].session_duration_sec == 1


def test_chunked_sessions_match_native(spark):
    """Chunked sessionisation equals Spark's own session_window, including
    sessions that span many chunks (one hot device)."""
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows, t = [], 0.0
    for i in range(3000):
        t += rnd.choice([1, 30, 200, 299, 300, 301, 900])
        rows.append((("hot" if i % 3 else f"d{i % 5}"), base + dt.timedelta(seconds=t)))
    df = spark.createDataFrame(rows, "device_id string, event_timestamp timestamp")
    mine = sessionize(df).select(
        "device_id", "session_start", "session_end", "events_in_session")
    native = (df.groupBy("device_id", F.session_window("event_timestamp", "5 minutes"))
              .agg(F.min("event_timestamp").alias("session_start"),
                   F.max("event_timestamp").alias("session_end"),
                   F.count(F.lit(1)).alias("events_in_session")).drop("session_window"))
    assert sorted(mine.collect()) == sorted(native.collect())
