"""Sharding by vector bin packing.

Bytes, tokens and rows are balanced jointly.  Items are groups of equal texts;
each item goes to the shard whose residual capacity has the highest dot
product with the item's size vector.

The number of items does not grow with the corpus.  A group that holds at
least 1/(shards * UNITS) of any total is an item of its own (at most
3 * shards * UNITS of them exist); lighter groups are bundled by hash into
shards * UNITS items; a group larger than a whole shard is cut into UNITS
pieces by row (at most 3 * shards such groups exist).  Item sizes are measured,
never estimated.  Everything else is a Spark aggregation or join.

Defined results: a null text has no bytes (size = 8), CRC 0, and forms a group
apart from the empty text; repeated rows are rows of their own, in one group;
an empty table gives no rows; other columns of the input are ignored unless
named in ``carry``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltline.llm.common import materialise, sized, text_hash

UNITS = 256
ROW_BYTES = 8  # fixed value: size of a row besides its text
ROWS_PER_RUN = 50_000  # rows that one window of the slot numbering sorts
DIMS = ("size", "tokens", "n")
LAW = "bytes"


def place(weights: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item.  ``weights``: items x dimensions, heaviest first, as
    shares of the totals.  Ties go to the lower shard."""
    residual = np.full((shards, weights.shape[1]), 1.0 / shards)
    out = np.empty(len(weights), np.int32)
    for i, w in enumerate(weights):
        fits = (residual >= w - 1e-12).all(axis=1)
        scores = residual @ w
        s = int(np.argmax(np.where(fits, scores, -np.inf) if fits.any() else scores))
        residual[s] -= w
        out[i] = s
    return out


def _items(df: DataFrame) -> DataFrame:
    return df.groupBy("kind", "key", "piece").agg(
        *(F.sum(d).cast("long").alias(d) for d in DIMS))


def assign_shards(docs: DataFrame, shards: int = 24, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, tokens, text_crc32, law, shard, slot, grown_shard (+ carry)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.lit(1).cast("long").alias("n"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_hash().alias("grp"), F.monotonically_increasing_id().alias("row"),
        *(F.col(c).alias(f"carry_{c}") for c in carry)), "shard-rows")
    spark = rows.sparkSession

    total = rows.agg(*(F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS)).first()
    share = shards * UNITS
    giant = F.lit(False)
    heavy = F.lit(False)
    for d in DIMS:
        giant = giant | (F.col(d) * shards > total[d])
        heavy = heavy | (F.col(d) * share >= total[d])
    groups = materialise(
        rows.groupBy("grp").agg(*(F.sum(d).alias(d) for d in DIMS))
        .withColumn("kind", F.when(giant & (F.col("n") > 1), 2).when(heavy, 1).otherwise(0)), "shard-groups")
    special = F.broadcast(groups.where("kind > 0").select("grp", "kind"))  # <= 6 * share rows

    kind = F.coalesce("kind", F.lit(0))
    placed_rows = (rows.join(special, "grp", "left").withColumn("kind", kind)
                   .withColumn("key", F.when(F.col("kind") == 0, F.pmod("grp", F.lit(share))).otherwise(F.col("grp")))
                   .withColumn("piece", F.when(F.col("kind") == 2, F.pmod(F.xxhash64("row"), F.lit(UNITS)))
                               .otherwise(F.lit(0)).cast("int")))
    light = groups.where("kind < 2").withColumn("piece", F.lit(0)).withColumn(
        "key", F.when(F.col("kind") == 0, F.pmod("grp", F.lit(share))).otherwise(F.col("grp")))
    items = _items(light).unionByName(_items(placed_rows.where("kind = 2"))).toPandas()
    sums = np.maximum([total[d] for d in DIMS], 1)
    items["weight"] = (items[list(DIMS)] / sums).sum(axis=1)
    items = items.sort_values(["weight", "kind", "key", "piece"], ascending=[False, True, True, True])
    items["shard"] = place((items[list(DIMS)] / sums).to_numpy(float), shards)
    home = spark.createDataFrame(
        list(items[["kind", "key", "piece", "shard"]].astype(int).itertuples(index=False, name=None)),
        "kind int, key long, piece int, shard int")
    runs = max(1, -(-int(total["n"]) // (shards * ROWS_PER_RUN)))
    placed = (placed_rows.join(F.broadcast(home), ["kind", "key", "piece"])
              .withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int")))
    # slots: rows before this run in the shard, plus the place in the run
    first = materialise(placed.groupBy("shard", "run").count()
                        .withColumn("first", F.sum("count").over(Window.partitionBy("shard").orderBy("run"))
                                    - F.col("count")).drop("count"), "shard-runs")
    place_in_run = F.row_number().over(
        Window.partitionBy("shard", "run").orderBy(F.col("doc_id").asc_nulls_last(), "row"))
    return (placed.withColumn("at", place_in_run - 1).join(sized(first), ["shard", "run"])
            .select("doc_id", "size", "tokens", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("first") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"),
                    *(F.col(f"carry_{c}").alias(c) for c in carry)))


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Documents as Parquet, one folder for each shard, rows by slot."""
    (assign_shards(docs, shards, carry=("text",)).repartition("shard")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
