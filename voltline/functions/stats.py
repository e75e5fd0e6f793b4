"""Mergeable statistics over double readings.

Averages and sample standard deviations are the engine's own.  Where readings
are first reduced to buckets and the buckets then to windows, a bucket keeps
its count, mean and sum of squared deviations; these merge pairwise without
squaring a reading or a mean, so a large mean costs no precision.
NaN and infinite readings give NaN results, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment_aggs(col: Column | str, prefix: str) -> list[Column]:
    """Count, mean and sum of squared deviations of a bucket."""
    n = F.count(col)
    return [n.alias(f"{prefix}_n"), F.avg(col).alias(f"{prefix}_mean"),
            (F.var_pop(col) * n).alias(f"{prefix}_m2")]


def merged_aggs(prefix: str) -> list[Column]:
    """Aggregates that merge buckets; feed them to the two functions below.  A
    window gathers one small struct for each of its buckets, a fixed number."""
    n = F.col(f"{prefix}_n")
    part = F.struct(n.cast("double").alias("n"), F.col(f"{prefix}_mean").alias("mean"), F.col(f"{prefix}_m2").alias("m2"))
    return [F.sum(n).alias(f"{prefix}_n"), F.collect_list(F.when(n > 0, part)).alias(f"{prefix}_parts")]


def _merge(a: Column, b: Column) -> Column:
    """Two buckets as one: squared deviations add up around the difference of
    the means, so the size of the mean itself does not matter."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    # means that differ in their last bits only: equal readings have no deviation
    apart = F.when(F.abs(apart) <= 8.9e-16 * F.greatest(F.abs(a["mean"]), F.abs(b["mean"])), 0.0).otherwise(apart)
    first = a["n"] == 0
    return F.struct(n.alias("n"), F.when(first, b["mean"]).otherwise(a["mean"] + apart * b["n"] / n).alias("mean"),
                    F.when(first, b["m2"]).otherwise(a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))


def merge_two(a: Column, b: Column) -> Column:
    """Two buckets (structs of n, mean, m2; either may be empty) as one."""
    return F.when(b["n"] == 0, a).otherwise(_merge(a, b))


def bucket(n: Column, mean: Column, var_pop: Column) -> Column:
    """Count, mean and population variance as a bucket; empty: zeros."""
    n, zero = n.cast("double"), F.lit(0.0)
    return F.struct(n.alias("n"), F.when(n > 0, mean).otherwise(zero).alias("mean"),
                    F.when(n > 0, var_pop * n).otherwise(zero).alias("m2"))


def _merged(prefix: str) -> Column:
    zero = F.lit(0.0)
    start = F.struct(zero.alias("n"), zero.alias("mean"), zero.alias("m2"))
    return F.aggregate(F.array_sort(f"{prefix}_parts"), start, _merge)  # sorted: the same in any order of arrival


def merged_mean(prefix: str) -> Column:
    """NULL for a window without readings."""
    return F.when(F.col(f"{prefix}_n") > 0, _merged(prefix)["mean"])


def merged_stddev(prefix: str) -> Column:
    """Sample standard deviation; NULL below two readings."""
    n = F.col(f"{prefix}_n")
    return F.when(n > 1, F.sqrt(_merged(prefix)["m2"] / (n - 1)))
