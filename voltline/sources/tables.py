"""Parquet table access for a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; projections and filters applied later
    are pushed into this scan by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
