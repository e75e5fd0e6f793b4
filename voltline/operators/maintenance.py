"""Table maintenance: clustering rewrite (compaction) and retention tiers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def interleave_bits(a: Column, b: Column, bits: int = 16) -> Column:
    """Z-order (Morton) key of two non-negative ints: bit i of ``a`` goes to
    bit 2i, bit i of ``b`` to bit 2i+1."""
    key = F.lit(0).cast("long")
    for i in range(bits):
        key = key.bitwiseOR(F.shiftleft(F.shiftright(a, i).bitwiseAND(1), 2 * i))
        key = key.bitwiseOR(F.shiftleft(F.shiftright(b, i).bitwiseAND(1), 2 * i + 1))
    return key


CELLS = 64  # quantile ranks of each column


def quantile_bounds(df: DataFrame, *columns: Column, cells: int = CELLS) -> list[list]:
    """Approximate quantiles that cut each numeric column into ``cells`` parts of
    equal size: one pass, ``cells`` - 1 numbers for each column come back."""
    at = [i / cells for i in range(1, cells)]
    row = df.agg(*(F.percentile_approx(c, at, 10_000).alias(f"c{i}") for i, c in enumerate(columns))).first()
    return [list(x or []) for x in row]


def quantile_rank(column: Column, bounds: list) -> Column:
    """How many bounds lie below the value (NULL sorts first)."""
    if not bounds:
        return F.lit(0)
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < column))
    return F.when(column.isNull(), F.lit(0)).otherwise(below)


def zorder_key(a: Column, b: Column, bounds: list[list], cells: int = CELLS) -> Column:
    """Morton key over the quantile ranks of two numeric columns.  Ranks follow
    the data, so neither a skewed column nor one far from 0 wastes bits."""
    return interleave_bits(quantile_rank(a, bounds[0]), quantile_rank(b, bounds[1]), max(1, (cells - 1).bit_length()))


def zorder_table(df: DataFrame, path: str, a: Column, b: Column, partition_by: str, num_files: int) -> None:
    """Writes ``df`` clustered on two columns at once, at most ``num_files`` files
    for a partition value: files cover narrow ranges of both columns, so a scan
    that filters on either skips most of them."""
    key = zorder_key(a, b, quantile_bounds(df, a, b))
    (df.withColumn("_z", key).repartitionByRange(num_files, partition_by, "_z").sortWithinPartitions(partition_by, "_z")
     .drop("_z").write.partitionBy(partition_by).parquet(path))


def cluster(df: DataFrame, cols: list[str], num_files: int) -> DataFrame:
    """Range-partition on the clustering columns and sort inside each
    partition: rows of one device and time range end up in few files with
    tight min/max statistics, so scans filtering on them skip row groups."""
    return df.repartitionByRange(num_files, *cols).sortWithinPartitions(*cols)


def compact_table(spark: SparkSession, src: str, dst: str, cols: list[str],
                  partition_by: list[str] | None = None,
                  rows_per_file: int = 5_000_000) -> int:
    """Rewrite a Parquet table clustered on ``cols`` into ``dst``; returns
    the number of output partitions.  The source is read once to size the
    output, then rewritten in one job.  The table's partition columns lead the
    range key, so a range holds whole table partitions or a part of one: at most
    ranges + table partitions - 1 files are written."""
    df = spark.read.parquet(src)
    n = df.count()
    files = max(1, -(-n // rows_per_file))
    w = cluster(df, [*(partition_by or []), *cols], files).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dst)
    return files


# Lifecycle rules (days since last change, strictly greater).
RETENTION_RULES = {
    "bronze": [("delete", 90), ("archive", 30), ("cool", 7)],
    "gold": [("delete", 365), ("cool", 30)],
}


def tier_for(layer: str, age: Column) -> Column:
    expr = None
    for tier, days in RETENTION_RULES[layer]:
        expr = F.when(age > days, tier) if expr is None else expr.when(age > days, tier)
    return expr.otherwise("hot")


def retention_plan(partitions: DataFrame, as_of: _dt.date) -> DataFrame:
    """(partition_date, rows) -> one row per layer and partition with its
    age in days and the storage tier the lifecycle rules put it in."""
    age = F.datediff(F.lit(as_of), F.col("partition_date")).cast("long")
    per_layer = partitions.select("*", F.explode(F.array(*[F.lit(x) for x in RETENTION_RULES]))
                                  .alias("layer")).withColumn("age_days", age)
    tier = None
    for layer in RETENTION_RULES:
        t = tier_for(layer, F.col("age_days"))
        tier = F.when(F.col("layer") == layer, t) if tier is None else tier.when(F.col("layer") == layer, t)
    return per_layer.withColumn("tier", tier).select("layer", "partition_date", "rows", "age_days", "tier")


def expired(spark: SparkSession, path: str, layer: str, as_of: _dt.date, column: str = "partition_date") -> list[_dt.date]:
    """Dates of the table's partitions that the layer's rules delete.  Only
    partition folders are read: a row for each date comes back."""
    dates = (spark.read.parquet(path).select(F.col(column).cast("date").alias("partition_date")).distinct()
             .withColumn("rows", F.lit(0)))
    plan = retention_plan(dates, as_of).where((F.col("layer") == layer) & (F.col("tier") == "delete"))
    return sorted(r.partition_date for r in plan.select("partition_date").collect())


def expire(spark: SparkSession, path: str, layer: str, as_of: _dt.date, column: str = "partition_date",
           at_most: int | None = None) -> list[_dt.date]:
    """Drops the partitions that the retention plan deletes, the oldest first,
    and returns their dates.  No row that stays is rewritten.  Each partition
    goes as a whole and the plan is derived from what is still there, so a run
    after a crash goes on where the last one stopped.  ``at_most``: partitions
    of this run."""
    gone = expired(spark, path, layer, as_of, column)[:at_most]
    for date in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={date.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
