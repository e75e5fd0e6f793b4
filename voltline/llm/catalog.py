"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm import (
    conversations,
    decontaminate,
    fim,
    jaccard,
    langid,
    lines,
    order,
    packing,
    quality,
    reputation,
    secrets,
    sharding,
    substring,
)
from voltline.llm.common import file_uri, table
from voltline.llm.oracle import ORACLE_SQL
from voltline.session import scratch_path

ORDER_KEY = 20_240_601  # fixed value: key of the training order


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf, "documents"))


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("text_key")


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf, "documents")))


def op5_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents")).drop("text_key", "component_key")


def op6_order(spark: SparkSession, sf: str) -> DataFrame:
    return order.training_order(table(spark, sf, "documents"), file_uri(scratch_path(spark, "training-order")), ORDER_KEY)


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"), labels=table(spark, sf, "labels")).select(
        "doc_id", *quality.STATS, "base_failed", "kept", "score")


def op8_langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.predict(table(spark, sf, "documents"))


def op9_substring(spark: SparkSession, sf: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf, "documents")).drop("text_key")


def op10_reputation(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1)
        .when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0).alias("bad"))
    return reputation.judge(table(spark, sf, "pages"), labels).withColumn("lower", F.round("lower", 6))


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(table(spark, sf, "documents")))


def op12_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.repaired_conversations(table(spark, sf, "conversations"))


def op13_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.digest(lines.drop_repeated_lines(table(spark, sf, "documents")))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_decontaminate, op3_packing, op4_secrets, op5_jaccard, op6_order,
                                   op7_quality, op8_langid, op9_substring, op10_reputation, op11_fill_in_middle,
                                   op12_conversations, op13_lines)}

__all__ = ["ORACLE_SQL", "QUERIES"]
