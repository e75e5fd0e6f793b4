"""Anomaly alerts: model flag OR temperature beyond 3 sigma of the device's
rolling statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltline.functions.stats import bucket, merge_two, merged_aggs, merged_mean, merged_stddev, moment_aggs

# Fixed value: detection method label written on every alert row.
DETECTION_METHOD = "statistical_outlier"

ALERT_INPUT = ["event_id", "device_id", "device_type", "region", "event_timestamp",
               "temperature_c", "anomaly_flag"]
MINUTE_US = 60_000_000
# Fixed value: rows that the stream's events of a device and a minute are dealt over.
CELL_PARTS = 16


def _trigger(flag: Column, stat: Column) -> Column:
    flag = F.coalesce(flag, F.lit(False))
    stat = F.coalesce(stat, F.lit(False))
    return (F.when(flag & stat, F.lit("BOTH")).when(flag, F.lit("MODEL"))
            .when(stat, F.lit("STATISTICAL")))


def sliding_stats(silver: DataFrame, size_minutes: int = 10, slide_minutes: int = 1) -> DataFrame:
    """Per device and sliding window: temperature mean and sample stddev.

    Readings are first reduced to one row per (device, minute) of mergeable
    moments; the sliding expansion then runs on that much smaller table."""
    per_minute = (silver.where(F.col("event_timestamp").isNotNull())
                  .groupBy("device_id", F.date_trunc("minute", "event_timestamp").alias("minute"))
                  .agg(*moment_aggs("temperature_c", "t")))
    return (per_minute
            .groupBy("device_id", F.window("minute", f"{size_minutes} minutes",
                                           f"{slide_minutes} minute").alias("w"))
            .agg(*merged_aggs("t"))
            .select("device_id",
                    F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    F.col("t_n").alias("rolling_n"), merged_mean("t").alias("rolling_avg_temp"),
                    merged_stddev("t").alias("rolling_std_temp")))


def alerts_range(silver: DataFrame, size_minutes: int = 10) -> DataFrame:
    """Every (event, window) pair where the event lies in the window
    (start <= ts <= end, both inclusive) and the event is model-flagged or
    its temperature is more than 3 sigma from the window mean.

    The BETWEEN self-join is evaluated as an equi-join on (device, minute):
    each window row is expanded to the minutes it covers (plus its end
    minute, which matches only an event exactly at the end), so no
    device-wide pairing of events and windows ever happens."""
    stats = sliding_stats(silver, size_minutes)
    per_minute = (stats
                  .select("*", F.explode(F.sequence(F.lit(0), F.lit(size_minutes))).alias("k"))
                  .select(F.col("device_id").alias("w_device"),
                          (F.col("window_start") + F.make_dt_interval(mins=F.col("k")))
                          .alias("w_minute"),
                          (F.col("k") == size_minutes).alias("end_only"),
                          "window_start", "window_end", "rolling_avg_temp", "rolling_std_temp"))
    ev = (silver.select(*ALERT_INPUT)
          .withColumn("minute", F.date_trunc("minute", "event_timestamp")))
    cond = ((F.col("device_id") == F.col("w_device")) & (F.col("minute") == F.col("w_minute"))
            & (~F.col("end_only") | (F.col("event_timestamp") == F.col("window_end"))))
    joined = ev.join(per_minute, cond, "left")
    stat = F.abs(F.col("temperature_c") - F.col("rolling_avg_temp")) > 3 * F.col("rolling_std_temp")
    return (joined.where(F.col("anomaly_flag") | stat)
            .select("event_id", "device_id", "device_type", "region", "event_timestamp",
                    "temperature_c", "rolling_avg_temp", "rolling_std_temp",
                    F.col("anomaly_flag").alias("model_anomaly_flag"),
                    F.lit(DETECTION_METHOD).alias("detection_method"),
                    _trigger(F.col("anomaly_flag"), stat).alias("trigger"),
                    "window_start", "window_end"))


def alerts_per_event(silver: DataFrame, size_minutes: int = 10) -> DataFrame:
    """One row per alerted event: windows that raised it, how many of them
    were statistical, the largest deviation seen."""
    r = alerts_range(silver, size_minutes)
    stat = (F.abs(F.col("temperature_c") - F.col("rolling_avg_temp"))
            > 3 * F.col("rolling_std_temp"))
    return (r.groupBy("event_id", "device_id", "device_type", "region", "event_timestamp",
                      "temperature_c", "model_anomaly_flag")
            .agg(F.count(F.lit(1)).alias("alert_windows"),
                 F.count_if(F.coalesce(stat, F.lit(False))).alias("stat_windows"),
                 F.max(F.abs(F.col("temperature_c") - F.col("rolling_avg_temp")))
                 .alias("max_abs_dev"))
            .withColumn("trigger", _trigger(F.col("model_anomaly_flag"), F.col("stat_windows") > 0)))


def alerts_trailing(silver: DataFrame, frame_seconds: int = 600, tasks: int | None = None) -> DataFrame:
    """Trailing-frame variant: statistics over the device's readings in
    [ts - 10 min, ts] (the event itself included).

    Time is cut into blocks as long as the frame.  The frame of an event is then
    the end of the previous block, from ts - 10 min on, and the start of its own
    block, up to ts.  Each reading is placed in its own block at its time, and in
    the next block one frame later; a running aggregate from the left gives the
    second part, one from the right the first, and the two merge.  So each row
    costs the same however dense the device is (a sliding frame reads its whole
    content again for each row), nothing is subtracted, and a hot device is
    spread over its blocks.  The blocks are dealt explicitly: rows that come
    dealt by device (from a join with a large registry) would satisfy the
    window as they lie, each device in one task.

    ``tasks``: how many tasks the blocks are dealt over; a task sorts its rows
    twice, in many times the bytes that were shuffled.  Not given: the session's
    partitions.

    A flagged event without event time has no frame, and is reported without
    statistics."""
    frame_us = frame_seconds * 1_000_000
    us = F.unix_micros("event_timestamp")
    # events without time are dealt over blocks by their id; their readings count in none
    block = F.coalesce(F.floor(us / F.lit(frame_us)), -1 - F.pmod(F.xxhash64("event_id"), F.lit(4096)))
    here = F.struct(block.alias("part"), us.alias("at"), F.lit(True).alias("own"))
    next_one = F.struct((block + 1).alias("part"), (us + frame_us).alias("at"), F.lit(False).alias("own"))
    places = F.when(us.isNotNull(), F.array(here, next_one)).otherwise(F.array(here))
    placed = (silver.select(*ALERT_INPUT).select("*", F.explode(places).alias("p"))
              .select("device_id", "p.part", "p.at", "p.own", F.when(F.col("p.at").isNotNull(), F.col("temperature_c")).alias("t"),
                      F.when(F.col("p.own"), F.struct(*ALERT_INPUT)).alias("row"))
              .repartition(*([tasks] if tasks else []), "device_id", "part"))
    by_block = Window.partitionBy("device_id", "part")
    up, down = by_block.orderBy(F.asc("at")), by_block.orderBy(F.desc("at"))  # ties included
    mine, before = F.when(F.col("own"), F.col("t")), F.when(~F.col("own"), F.col("t"))
    halves = placed.select("row", "own", "at", *(
        bucket(F.count(x).over(w), F.avg(x).over(w), F.var_pop(x).over(w)).alias(name)
        for name, x, w in (("mine", mine, up), ("before", before, down))))
    merged = halves.where("own").select("row.*", "at", merge_two(F.col("before"), F.col("mine")).alias("f"))
    n = F.col("f.n")
    out = merged.select(*ALERT_INPUT, F.when(F.col("at").isNotNull(), n.cast("long")).alias("trailing_n"),
                        F.when(n > 0, F.col("f.mean")).alias("trailing_avg_temp"),
                        F.when(n > 1, F.sqrt(F.col("f.m2") / (n - 1))).alias("trailing_std_temp"))
    stat = F.abs(F.col("temperature_c") - F.col("trailing_avg_temp")) > 3 * F.col("trailing_std_temp")
    return (out.where(F.col("anomaly_flag") | stat)
            .select("event_id", "device_id", "device_type", "region", "event_timestamp",
                    "temperature_c", "trailing_n", "trailing_avg_temp", "trailing_std_temp",
                    F.col("anomaly_flag").alias("model_anomaly_flag"),
                    _trigger(F.col("anomaly_flag"), stat).alias("trigger")))


def _with_alerts(pairs: DataFrame, cell: list[str]) -> DataFrame:
    """One row per event of the cell (``rows``) that the row's statistics alert on."""
    def alerts(e: Column) -> Column:
        return e["anomaly_flag"] | (F.abs(e["temperature_c"] - F.col("rolling_avg_temp")) > 3 * F.col("rolling_std_temp"))
    others = [c for c in pairs.columns if c != "rows"]
    return (pairs.select(*others, F.explode(F.filter("rows", alerts)).alias("e"))
            .select(*others, *(F.col(f"e.{c}").alias(c) for c in cell)))


def alerts_stream(silver_stream: DataFrame, size_minutes: int = 10,
                  watermark: str = "1 minute") -> DataFrame:
    """Streaming twin: stream-stream join of events with the windowed
    statistics.  Windows are half-open here, so each event meets exactly
    ``size_minutes`` windows.

    Events are kept in cells: the events of a device, a minute and one of
    ``CELL_PARTS`` parts lie in one row, as an array.  Windows start on whole
    minutes, so a window holds all of a cell or nothing of it, and the join pairs
    cells with windows; only events that alert are taken out of the pair.  State
    and probes so count cells, not events, however dense a device is.  What the
    cell has in common (device, type, region) is kept once.  A cell closes with
    its minute, which is no later than the first of its windows; an event that
    comes behind the watermark still counts while its minute is open.

    The statistics side exposes its window as an event-time column
    (``window_time``: the window's last instant), the cells theirs, and the join
    is a time range, ``wt - size < ct <= wt``.  Spark derives watermark eviction
    for both sides from that condition, so every event is buffered once (not
    once per window) and dropped as soon as its last window has closed.

    Besides the device, both sides carry an aligned ``size``-long bucket id
    as an equality key: a window overlaps at most two buckets (its row is
    repeated for each), so a statistics row only probes the cells of its
    own device *and* time bucket instead of every buffered cell of the
    device.

    The join is a left join, as in batch: an event that meets no statistics is
    emitted once its last window has closed, and stays if it is flagged.  A
    flagged event without event time can meet none, and no watermark would ever
    release it from the join, so a stateless branch reports it at once."""
    bucket_s = size_minutes * 60
    common, cell = ["device_id", "device_type", "region"], ["event_id", "event_timestamp", "temperature_c", "anomaly_flag"]
    timeless = (silver_stream.select(*ALERT_INPUT).where(F.col("event_timestamp").isNull() & F.col("anomaly_flag")))
    base = (silver_stream.select(*ALERT_INPUT).where(F.col("event_timestamp").isNotNull())
            .withWatermark("event_timestamp", watermark))
    cells = (base.groupBy(*common, F.window("event_timestamp", "1 minute").alias("m"),
                          F.pmod(F.xxhash64("event_id"), F.lit(CELL_PARTS)).alias("part"))
             .agg(F.collect_list(F.struct(*cell)).alias("rows"))
             .select(*common, F.window_time("m").alias("ct"),
                     F.floor(F.unix_seconds(F.col("m.start")) / bucket_s).alias("bucket"), "rows"))
    stats = (base.groupBy(F.col("device_id").alias("r_device"),
                          F.window("event_timestamp", f"{size_minutes} minutes", "1 minute").alias("w"))
             .agg(F.avg("temperature_c").alias("rolling_avg_temp"),
                  F.stddev_samp("temperature_c").alias("rolling_std_temp"))
             .select("r_device", F.window_time("w").alias("wt"),
                     F.explode(F.array_distinct(F.array(
                         F.floor(F.unix_seconds(F.col("w.start")) / bucket_s),
                         F.floor(F.unix_seconds(F.window_time("w")) / bucket_s)))).alias("r_bucket"),
                     F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "rolling_avg_temp", "rolling_std_temp"))
    span = F.expr(f"INTERVAL {size_minutes} MINUTES")
    cond = ((F.col("device_id") == F.col("r_device")) & (F.col("bucket") == F.col("r_bucket"))
            & (F.col("ct") > F.col("wt") - span)
            & (F.col("ct") <= F.col("wt")))
    none = {"rolling_avg_temp": "double", "rolling_std_temp": "double", "window_start": "timestamp", "window_end": "timestamp"}
    joined = _with_alerts(cells.join(stats, cond, "leftOuter").select(*common, "rows", *none), cell)
    joined = joined.select(*ALERT_INPUT, *none).unionByName(
        timeless.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items())))
    stat = F.abs(F.col("temperature_c") - F.col("rolling_avg_temp")) > 3 * F.col("rolling_std_temp")
    return (joined.where(F.col("anomaly_flag") | stat)
            .select("event_id", "device_id", "device_type", "region", "event_timestamp",
                    "temperature_c", "rolling_avg_temp", "rolling_std_temp",
                    F.col("anomaly_flag").alias("model_anomaly_flag"),
                    F.lit(DETECTION_METHOD).alias("detection_method"),
                    _trigger(F.col("anomaly_flag"), stat).alias("trigger"),
                    "window_start", "window_end"))
