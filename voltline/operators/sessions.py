"""Inactivity-gap sessions per device, safe for very hot devices.

Spark's batch ``session_window`` shuffles on the device key alone, so a
device that owns a third of all rows would be sessionised by one task.  Here:

1. Rows are reduced to one piece (first, last, count) per (device, bucket of
   ``gap`` length).  No gap longer than ``gap`` fits inside a bucket, so a
   piece is never cut; the reduction combines before the shuffle, so raw rows
   are neither shuffled nor sorted.
2. Pieces are stitched per device: a piece continues the previous one when it
   starts within ``gap`` of its end.
3. Pieces are summed into sessions.

A gap of exactly ``gap`` keeps the session open (the next event falls on
the end of the previous session window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltline.functions.timefmt import seconds_between


def sessionize(df: DataFrame, key: str = "device_id", ts: str = "event_timestamp",
               gap_seconds: int = 300) -> DataFrame:
    """(key, ts) rows -> (key, session_start, session_end, events_in_session).

    Rows with a NULL key or time are ignored, like window functions do."""
    gap_us = gap_seconds * 1_000_000
    pieces = (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
              .select(F.col(key).alias("k"), F.unix_micros(ts).alias("us"))
              .groupBy("k", F.floor(F.col("us") / F.lit(gap_us)).alias("bucket"))
              .agg(F.min("us").alias("p_first"), F.max("us").alias("p_last"), F.count(F.lit(1)).alias("p_n")))
    by_key = Window.partitionBy("k").orderBy("p_first")
    prev_last = F.lag("p_last").over(by_key)
    stitched = (pieces
                .withColumn("s_open", F.when(prev_last.isNull()
                                             | (F.col("p_first") - prev_last > gap_us),
                                             F.col("p_first")))
                .withColumn("session", F.last("s_open", ignorenulls=True).over(
                    by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (stitched.groupBy("k", "session")
            .agg(F.min("p_first").alias("first_us"), F.max("p_last").alias("last_us"),
                 F.sum("p_n").alias("events_in_session"))
            .select(F.col("k").alias(key),
                    F.timestamp_micros("first_us").alias("session_start"),
                    F.timestamp_micros("last_us").alias("session_end"),
                    "events_in_session"))


def device_sessions(tel: DataFrame, gap_seconds: int = 300) -> DataFrame:
    """Sessions with duration in whole-second boundaries crossed."""
    s = sessionize(tel, "device_id", "event_timestamp", gap_seconds)
    return s.withColumn("session_duration_sec", seconds_between("session_start", "session_end"))


def device_sessions_stream(tel: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """Streaming form: Spark's stateful session window (the stream is already
    incremental, so per-device state only holds open sessions)."""
    return (tel.groupBy("device_id", F.session_window("event_timestamp", gap).alias("sw"))
            .agg(F.min("event_timestamp").alias("session_start"),
                 F.max("event_timestamp").alias("session_end"),
                 F.count(F.lit(1)).alias("events_in_session"))
            .select("device_id", "session_start", "session_end", "events_in_session",
                    seconds_between("session_start", "session_end").alias("session_duration_sec")))


def silent_devices(tel: DataFrame, silence_seconds: int = 300) -> DataFrame:
    """Devices whose last event is more than ``silence_seconds`` before the
    latest event time seen (a scalar subquery, evaluated once)."""
    last = tel.where(F.col("event_timestamp").isNotNull()) \
              .groupBy("device_id").agg(F.max("event_timestamp").alias("last_seen"))
    now = tel.select(F.max("event_timestamp")).scalar()
    silent_for = F.unix_micros(now) - F.unix_micros(F.col("last_seen"))
    return (last.withColumn("silent_for_sec", (silent_for / F.lit(1_000_000.0)))
                .withColumn("is_silent", silent_for > silence_seconds * 1_000_000))
