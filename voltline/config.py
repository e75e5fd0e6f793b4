"""Pipeline configuration read from the Spark session (``pipeline.*``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from voltline.session import checkpoint_dir


@dataclass(frozen=True)
class PipelineConfig:
    storage: str          # root of the table folders (shared storage)
    checkpoints: str      # root of streaming checkpoints
    topic: str
    registry_path: str
    registry_format: str

    @property
    def bronze(self) -> str:
        return f"{self.storage}/bronze/telemetry"

    @property
    def silver(self) -> str:
        return f"{self.storage}/silver/telemetry_clean"

    @property
    def gold_kpis(self) -> str:
        return f"{self.storage}/gold/device_kpis"

    @property
    def gold_alerts(self) -> str:
        return f"{self.storage}/gold/anomaly_alerts"

    @classmethod
    def from_spark(cls, spark: SparkSession) -> "PipelineConfig":
        """Settings with defaults; the storage root defaults to a folder
        next to the session's checkpoint directory."""
        base = checkpoint_dir(spark)
        storage = spark.conf.get("pipeline.storage", f"{base}/tables")
        return cls(
            storage=storage.rstrip("/"),
            checkpoints=spark.conf.get("pipeline.checkpoints", f"{base}/streams").rstrip("/"),
            topic=spark.conf.get("pipeline.hub.topic", "telemetry-events"),
            registry_path=spark.conf.get("pipeline.registry.path", f"{storage}/registry"),
            registry_format=spark.conf.get("pipeline.registry.format", "parquet"),
        )
