import pytest

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltline.operators.maintenance import compact_table
from voltline.plans import inputs as I
from voltline.sources import fixture
from voltline.streaming.sources import hub_folder_stream


def per_file_count(df):
    return df.select(F.input_file_name()).distinct().count()


def test_registry_is_read_for_each_batch(spark, tmp_path):
    from voltline.operators.bronze import project_bronze
    from voltline.sources.registry import read_registry
    from voltline.streaming import jobs

    path, silver = str(tmp_path / "registry"), str(tmp_path / "silver")
    reg = I.registry(spark, SF_SMALL)
    reg.write.parquet(path)
    jobs.ensure_table(spark, silver, jobs.SILVER_TABLE_SCHEMA, ["batch_id", "event_date"])
    upsert = jobs.silver_upsert_batch(spark, silver, lambda: read_registry(spark, path))
    bronze = project_bronze(fixture.kafka_records(I.events(spark, SF_SMALL)))
    early = F.col("kafka_offset") % 2 == 0
    upsert(bronze.where(early), 0)
    reg.withColumn("region", F.lit("MOVED")).write.mode("overwrite").parquet(path)  # replaced between batches
    upsert(bronze.where(~early), 1)
    table = spark.read.schema(jobs.SILVER_TABLE_SCHEMA).parquet(silver)
    regions = {b: {r.region for r in table.where(f"batch_id = {b}").select("region").distinct().collect()} for b in (0, 1)}
    assert "MOVED" not in regions[0] and regions[1] == {"MOVED"}


def test_replay_of_a_landed_batch_keeps_its_files(spark, tmp_path):
    """A stream that has read the files must not meet them again under new names."""
    from voltline.operators.bronze import project_bronze
    from voltline.streaming import jobs

    silver, landed = str(tmp_path / "silver"), str(tmp_path / "landed")
    jobs.ensure_table(spark, silver, jobs.SILVER_TABLE_SCHEMA, ["batch_id", "event_date"])
    upsert = jobs.silver_upsert_batch(spark, silver, I.registry(spark, SF_SMALL), landed)
    bronze = project_bronze(fixture.kafka_records(I.events(spark, SF_SMALL)))
    early = F.col("kafka_offset") % 2 == 0
    files = []
    for batch, rows in ((0, bronze.where(early)), (0, bronze.where(early)), (1, bronze.where(~early))):
        upsert(rows, batch)
        files.append(set(spark.read.schema(jobs.SILVER_TABLE_SCHEMA).parquet(silver).inputFiles()))
    assert files[0] == files[1] < files[2]


def test_compact_table_preserves_rows_and_clusters(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    s = I.silver(spark, SF_SMALL).select("event_id", "device_id", "event_timestamp", "event_date")
    s.repartition(7).write.parquet(src)
    files = compact_table(spark, src, dst, ["device_id", "event_timestamp"],
                          partition_by=["event_date"], rows_per_file=300)
    out = spark.read.parquet(dst)
    assert files == -(-s.count() // 300)
    assert sorted(out.select("event_id").collect()) == sorted(s.select("event_id").collect())
    assert per_file_count(out) <= files + s.select("event_date").distinct().count() - 1
    # range partitioning: a device spills into a second file only at a range
    # boundary, so (file, device) pairs <= devices + files per date partition
    per_file = (out.withColumn("f", F.input_file_name()).groupBy("event_date", "f")
                .agg(F.count_distinct("device_id").alias("d")))
    dates = out.select("event_date").distinct().count()
    devices = s.select("device_id").distinct().count()
    assert per_file.agg(F.sum("d")).first()[0] <= dates * (devices + files)
    # hash-scattered input would put (almost) every device in every file
    scattered = (spark.read.parquet(src).withColumn("f", F.input_file_name()).groupBy("f")
                 .agg(F.count_distinct("device_id").alias("d")).agg(F.sum("d")).first()[0])
    assert per_file.agg(F.sum("d")).first()[0] < scattered


def test_start_pipeline_with_config(spark, tmp_path):
    from voltline.config import PipelineConfig
    from voltline.streaming.medallion import start_pipeline

    root = str(tmp_path)
    spark.conf.set("pipeline.storage", f"{root}/tables")
    spark.conf.set("pipeline.checkpoints", f"{root}/streams")
    try:
        cfg = PipelineConfig.from_spark(spark)
        I.registry(spark, SF_SMALL).write.parquet(cfg.registry_path)
        hub = f"{root}/hub"
        fixture.kafka_records(I.events(spark, SF_SMALL)).write.parquet(hub)
        # a bounded run lands upstream output before downstream jobs start
        for q in start_pipeline(spark, hub_folder_stream(spark, hub), cfg, available_now=True):
            q.awaitTermination()
        from voltline.streaming.jobs import SILVER_TABLE_SCHEMA
        silver = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(cfg.silver)
        assert silver.count() == silver.select("event_id").distinct().count() > 0
    finally:
        spark.conf.unset("pipeline.storage")
        spark.conf.unset("pipeline.checkpoints")


def test_batch_partitions_follow_its_rows(spark, monkeypatch):
    from voltline.streaming import jobs
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(jobs, "ROWS_PER_PARTITION", 10)
    with jobs.batch_partitions(spark.range(1001)):
        assert spark.conf.get(keys[0]) == "101"
    with pytest.raises(ValueError), jobs.batch_partitions(spark.range(1)):
        assert spark.conf.get(keys[0]) == before[0]  # never fewer
        raise ValueError
    assert [spark.conf.get(k) for k in keys] == before
