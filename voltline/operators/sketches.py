"""Mergeable metric sketches: one row for each minute and device type.

Longer windows are merged from the stored rows; raw readings are not read again.

* Distinct devices: HyperLogLog sketches, which are exact for small sets and
  within about 1.6 % (one standard error) beyond.
* Latency quantiles: counts by logarithmic bucket, ``GAMMA`` ** (i - 1) < ms <=
  ``GAMMA`` ** i.  A quantile is read off as the middle of its bucket, so it is
  within ``ERROR`` of the exact value, relative to it, for any window and any
  order of merging.  Latencies up to 0 have a bucket of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltline.functions.timefmt import hub_latency_ms

ERROR = 0.01
GAMMA = (1 + ERROR) / (1 - ERROR)
LG_K = 12
QUANTILES = (0.5, 0.95, 0.99)


def latency_bucket(ms: Column) -> Column:
    return F.when(ms > 0, F.ceil(F.log(ms.cast("double")) / F.lit(math.log(GAMMA))).cast("int"))


def minute_latencies(tel: DataFrame) -> DataFrame:
    """device_type, minute, bucket, n: at most some hundreds of rows a minute and type."""
    ms = hub_latency_ms()
    return (tel.where(F.col("event_timestamp").isNotNull())
            .groupBy("device_type", F.date_trunc("minute", "event_timestamp").alias("minute"), latency_bucket(ms).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def minute_devices(tel: DataFrame) -> DataFrame:
    """device_type, minute, devices (a sketch), events."""
    return (tel.where(F.col("event_timestamp").isNotNull())
            .groupBy("device_type", F.date_trunc("minute", "event_timestamp").alias("minute"))
            .agg(F.hll_sketch_agg("device_id", F.lit(LG_K)).alias("devices"), F.count(F.lit(1)).alias("events")))


def merged_latencies(minutes: DataFrame) -> DataFrame:
    """device_type and its latency quantiles, from stored minutes.  One row for
    each bucket of a type takes part in the window: some hundreds."""
    merged = minutes.groupBy("device_type", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("device_type").orderBy(F.asc_nulls_first("bucket"))
    ranked = merged.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy("device_type"))})
    middle = F.coalesce(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1), F.lit(0.0))
    return ranked.groupBy("device_type").agg(*(
        F.min_by(middle, F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("total")), F.col("upto"))).alias(f"p{round(q * 100)}_ms")
        for q in QUANTILES))


def merged_devices(minutes: DataFrame) -> DataFrame:
    return minutes.groupBy("device_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("active_devices"), F.sum("events").alias("events"))
