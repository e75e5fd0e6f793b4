"""Device registry snapshot reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltline.schemas import REGISTRY_COLUMNS


def read_registry(spark: SparkSession, path: str, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """Read a registry snapshot in any Spark data source format and keep the
    five registry columns (column pruning reaches the scan)."""
    return (spark.read.format(fmt).options(**(options or {})).load(path)
            .select(*REGISTRY_COLUMNS))
