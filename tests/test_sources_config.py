from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltline.config import PipelineConfig
from voltline.operators.bronze import read_bronze
from voltline.plans import inputs as I
from voltline.sources.registry import read_registry
from voltline.streaming.sources import hub_options


def test_hub_options_from_session(spark):
    keys = ["pipeline.hub.bootstrap", "pipeline.hub.topic", "pipeline.hub.kafka.security.protocol"]
    try:
        spark.conf.set(keys[0], "broker:9093")
        spark.conf.set(keys[1], "telemetry-test")
        spark.conf.set(keys[2], "SASL_SSL")
        opts = hub_options(spark)
        assert opts["kafka.bootstrap.servers"] == "broker:9093"
        assert opts["subscribe"] == "telemetry-test"
        assert opts["kafka.security.protocol"] == "SASL_SSL"
        assert opts["maxOffsetsPerTrigger"] == "500000" and opts["startingOffsets"] == "latest"
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_pipeline_config_defaults(spark):
    cfg = PipelineConfig.from_spark(spark)
    assert cfg.silver.endswith("/silver/telemetry_clean") and cfg.topic == "telemetry-events"


def test_registry_reader_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "reg")
    I.registry(spark, SF_SMALL).withColumn("extra", F.lit(1)).write.parquet(path)
    reg = read_registry(spark, path)
    assert reg.columns == ["device_id", "site_name", "region", "owner_team", "sla_tier"]
    assert "extra" not in reg._jdf.queryExecution().executedPlan().toString()


def test_bronze_merge_schema(spark, tmp_path):
    path = str(tmp_path / "bronze")
    b = I.bronze(spark, SF_SMALL)
    b.limit(5).write.mode("append").parquet(path)
    b.limit(5).withColumn("schema_version", F.lit(2)).write.mode("append").parquet(path)
    merged = read_bronze(spark, path)
    assert "schema_version" in merged.columns and merged.count() == 10
    assert merged.where(F.col("schema_version").isNull()).count() == 5
