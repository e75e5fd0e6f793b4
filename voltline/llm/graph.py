"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import BROADCAST_ROWS, materialise, release


def _star(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """Links each node's larger (or no larger) neighbours to its smallest one.
    Minima are combined before the shuffle; the join back can be split, so a
    hub is no hot task.  ``few``: the minima are proven few enough to broadcast."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = both.join(F.broadcast(least) if few else least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # here v < u: v and u itself go to the minimum
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none: the components."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where(
        "out + into > 1 AND out > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge.
    ``edges``: u, v of one comparable type; each round is written to the shared
    folder, so a lost executor costs at most one round."""
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u != v").distinct(), "edges")
    while not _is_stars(now):
        few = 2 * now.count() <= BROADCAST_ROWS  # an edge has two nodes, each with one minimum
        done, now = now, materialise(_star(_star(now, True, few), False, few), "edges")
        release(done)
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialise(out.unionByName(roots), "components")


def merged(found: DataFrame, edges: DataFrame) -> DataFrame:
    """``found``, as of ``components``, after more edges: only the components
    that these join are worked on again."""
    of_u = found.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    of_v = found.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    joined = components(edges.join(of_u, "u", "left").join(of_v, "v", "left").select(
        F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    now = joined.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = found.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return materialise(old.unionByName(joined.join(found.select("node"), "node", "left_anti")), "components")
