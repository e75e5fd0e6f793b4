"""Plan-shape checks: the skew-safe partitioning must survive refactors."""

import re

from voltline.operators import alerts
from voltline.operators.joins import BROADCAST_MAX_BYTES, broadcast_if_small, measured_bytes
from voltline.operators.silver import enrich
from voltline.plans import inputs as I
from voltline.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def _exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_sessions_never_shuffle_rows_by_device_alone(spark):
    plan = _plan(QUERIES["asa_sessions"](spark, SF_SMALL))
    keys = [k.replace(" ", "") for k in _exchanges(plan)]
    # rows are shuffled by (device, time bucket); only what these are reduced to, by device
    assert any(k.startswith("k,_groupingexpression") for k in keys)
    for below in re.split(r"Exchange hashpartitioning\(k, \d+\)", plan)[1:]:
        first = re.search(r"Exchange hashpartitioning\(([^)]*)\)", below)
        assert "HashAggregate" in below[:first.start()] and first[1].startswith("k, _groupingexpression")


def test_trailing_frame_partitioned_by_device_and_chunk(spark):
    plan = _plan(QUERIES["alerts_trailing"](spark, SF_SMALL))
    keys = [k.replace(" ", "") for k in _exchanges(plan)]
    assert any(k.startswith("device_id,part") for k in keys)
    assert not any(re.fullmatch(r"device_id,\d+", k) for k in keys)


def test_trailing_frame_deals_blocks_of_rows_that_lie_by_device(spark):
    rows = I.silver(spark, SF_SMALL).repartition(5, "device_id")  # as after a join with a large registry
    keys = [k.replace(" ", "") for k in _exchanges(_plan(alerts.alerts_trailing(rows)))]
    assert any(k.startswith("device_id,part") for k in keys)
    assert "device_id, part, 7)" in _plan(alerts.alerts_trailing(rows, tasks=7))


def test_tasks_grow_with_the_events(spark, monkeypatch):
    n = I.events(spark, SF_SMALL).count()
    monkeypatch.setattr(I, "ROWS_PER_TASK", 10)
    assert I.tasks(spark, SF_SMALL) == -(-n // 10)
    assert f"device_id, part, {-(-n // 10)})" in _plan(QUERIES["alerts_trailing"](spark, SF_SMALL))


def test_registry_broadcast_and_kpis_grouped_by_window(spark):
    plan = _plan(QUERIES["gold_kpis"](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin [device_id]" in plan
    assert any(k.startswith("window, device_id") for k in _exchanges(plan))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_range_alerts_join_on_device_and_minute(spark):
    plan = _plan(QUERIES["alerts_range"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert any(k.startswith("device_id, minute") for k in _exchanges(plan))


def test_broadcast_only_below_bound(spark):
    reg = I.registry(spark, SF_SMALL)
    rows, size = measured_bytes(reg)
    assert rows > 0 and size > 0
    tel = I.telemetry(spark, SF_SMALL)
    big = _plan(tel.join(broadcast_if_small(reg, max_bytes=1), "device_id", "left"))
    assert "BroadcastHashJoin [device_id]" not in big   # no hint above the bound
    small = _plan(enrich(tel, reg))
    assert "BroadcastHashJoin [device_id]" in small


def test_large_registry_is_cut_to_the_devices_met(spark):
    from pyspark.sql import functions as F

    # over the bound as a whole; two rows of one device, one device unknown, one null
    text = F.lpad(F.col("id").cast("string"), 120, "x")
    reg = spark.range(400_000).select(
        F.concat(F.lit("device-"), (F.col("id") % 399_999).cast("string")).alias("device_id"), text.alias("site_name"),
        F.lit("EUROPE").alias("region"), F.lit("t").alias("owner_team"), F.lit("s").alias("sla_tier"))
    assert measured_bytes(reg)[1] > BROADCAST_MAX_BYTES
    tel = spark.createDataFrame([(0, "device-0"), (1, "device-7"), (2, "no"), (3, None), (None, "device-7")],
                                "event_id int, device_id string")
    out = enrich(tel, reg)
    plan = _plan(out)
    assert "BroadcastHashJoin [device_id], [device_id], LeftOuter" in plan
    want = tel.join(reg, "device_id", "left")
    assert out.columns == want.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and out.count() == 6
    # too many devices for a broadcast: the same rows by a shuffle join
    cut = broadcast_if_small(reg, max_bytes=1, met=tel.select("device_id"))
    assert "BroadcastHashJoin [device_id], [device_id], LeftOuter" not in _plan(tel.join(cut, "device_id", "left"))
    assert cut.columns == reg.columns and cut.count() == 3


def test_hub_records_are_dealt_by_offset(spark):
    from voltline.sources import fixture
    keys = _exchanges(_plan(fixture.kafka_records(I.events(spark, SF_SMALL))))
    assert keys and all(k.startswith("kafka_offset") for k in keys)  # never by device: a hot one is spread


def test_size_check_is_cached_per_snapshot(spark, tmp_path):
    from voltline.operators import joins
    path = str(tmp_path / "reg")
    I.registry(spark, SF_SMALL).write.parquet(path)
    reg = spark.read.parquet(path)
    joins.broadcast_if_small(reg)
    key = joins._snapshot_key(reg)
    assert key in joins._MEASURED
    # a new snapshot (new files) is measured again
    I.registry(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    assert joins._snapshot_key(spark.read.parquet(path)) != key
