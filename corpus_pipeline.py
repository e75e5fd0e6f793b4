"""Corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing.

Each stage takes the documents its predecessor kept; all but the last return
the columns of ``documents``.  Documents that the quality rules reject, that
are near duplicates of one with a smaller doc_id, or that hold a benchmark
item leave; secrets are masked in the text; the rest is packed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm import decontaminate, jaccard, packing, quality, secrets
from voltline.llm.common import materialise, sized, table, text_hash


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows of the (doc_id, text_key) in ``keys``."""
    gone = sized(materialise(keys.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
                             .distinct(), "gone"))
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"),
                         text_hash().alias("row_key"))
    return packed.join(gone, F.col("row_id").eqNullSafe(F.col("gone_id")) & (F.col("row_key") == F.col("gone_key")),
                       "left_anti").select("row.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    try:
        labels = table(spark, sf_dir, "labels")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        labels = None  # a corpus without labels
    judged = quality.judge(docs, carry=tuple(docs.columns), labels=labels)
    return judged.where("kept").select(*(F.col(f"carry_{c}").alias(c) for c in docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group stays (smallest doc_id, null last, then
    smallest hash of the text); of repeated rows, one."""
    classes = materialise(jaccard.near_duplicates(docs), "classes")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    kept = _without(docs, classes.where(~first))
    again = classes.groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = sized(materialise(again, "again"))
    rows = kept.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"))
    # only rows that share their doc_id need to be compared with each other
    alone = rows.join(again, F.col("row_id").eqNullSafe(F.col("doc_id")), "left_anti").select("row.*")
    repeated = rows.join(again, F.col("row_id").eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")
    return alone.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans become a mark; n_chars follows the text."""
    found = secrets.find_secrets(docs, carry=tuple(docs.columns)).withColumn("hit", F.size("spans") > 0)
    found = found.withColumn("masked", F.when(F.col("hit"), secrets.redacted(F.col("text"), F.col("spans")))
                             .otherwise(F.col("carry_text")))
    # the length is taken from the masked column itself
    of = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        of["n_chars"] = F.when(F.col("hit"), F.length("masked")).otherwise(F.col("carry_n_chars")).cast("long")
    return found.select(*(of.get(c, F.col(f"carry_{c}")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("decontaminate", drop_leaks),
          ("secrets", mask_secrets), ("packing", pack)]

# Language models, LSH and packing cannot be written as SQL; tests compare the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
