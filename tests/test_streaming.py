import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltline.plans import inputs as I
from voltline.sources import fixture
from voltline.streaming import replay as R
from voltline.streaming.jobs import SILVER_TABLE_SCHEMA


def test_stream_equals_batch_and_restart_is_idempotent(spark):
    recs = fixture.kafka_records(I.events(spark, SF_SMALL))
    p = R.replay(spark, recs, I.registry(spark, SF_SMALL), {"bronze", "silver", "gold"})
    silver = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(p.silver)
    # every event once, despite duplicate deliveries and three restarts
    assert silver.count() == silver.select("event_id").distinct().count()
    # running again with no new input adds nothing
    R.run_round(spark, p, I.registry(spark, SF_SMALL), {"bronze", "silver"})
    assert spark.read.schema(SILVER_TABLE_SCHEMA).parquet(p.silver).count() == silver.count()
    gold = spark.read.parquet(p.gold)
    assert gold.count() > 0 and gold.where(F.col("device_id").isNull()).count() == 0


def test_late_event_beyond_watermark_dropped(spark, tmp_path):
    from voltline.streaming import jobs
    from voltline.schemas import KAFKA_SCHEMA
    import json

    def rec(eid, ts, off):
        v = {"event_id": eid, "device_id": "device-1000", "timestamp_utc": ts.isoformat() + "+00:00",
             "temperature_c": 20.0, "humidity_pct": 50.0, "battery_pct": 50.0,
             "latitude": 51.0, "longitude": 0.0, "anomaly_flag": False}
        return (b"device-1000", json.dumps(v).encode(), "t", 0, off, ts)

    t0 = dt.datetime(2024, 1, 1, 0, 10, 0)
    hub, root = str(tmp_path / "hub"), str(tmp_path)
    reg = spark.createDataFrame([("device-1000", "s", "EUROPE", "team", "GOLD")],
                                "device_id string, site_name string, region string, owner_team string, sla_tier string")
    paths = R.Paths.under(root)
    paths.hub = hub

    def land(rows):
        spark.createDataFrame(rows, KAFKA_SCHEMA).write.mode("append").parquet(hub)

    land([rec("a", t0, 1)])
    R.run_round(spark, paths, reg, {"bronze", "silver", "gold"})
    # watermark = 00:10 - 2 min = 00:08.  A row is dropped when its window has
    # closed (window end <= watermark): 00:07:59 still joins the open window
    # [00:05, 00:10); 00:04:59 belongs to [00:00, 00:05), closed -> dropped.
    land([rec("kept", t0 - dt.timedelta(seconds=121), 2), rec("late", t0 - dt.timedelta(seconds=301), 3)])
    R.run_round(spark, paths, reg, {"bronze", "silver", "gold"})
    land([rec("sentinel", t0 + dt.timedelta(days=1), 4)])
    for _ in range(2):
        R.run_round(spark, paths, reg, {"bronze", "silver", "gold"})
    gold = spark.read.parquet(paths.gold).orderBy("window_start").collect()
    by_start = {g.window_start.minute: g.event_count for g in gold}
    assert by_start.get(10) == 1          # "a"
    assert by_start.get(5) == 1           # "kept"
    assert 0 not in by_start              # "late" dropped
    assert jobs.KPI_WATERMARK == "2 minutes"


def test_alert_join_state_holds_each_event_once(spark):
    from voltline.operators.alerts import alerts_stream
    from voltline.session import scratch_path
    from voltline.streaming.jobs import silver_stream

    recs = fixture.kafka_records(I.events(spark, SF_SMALL))
    p = R.replay(spark, recs, I.registry(spark, SF_SMALL), {"bronze", "silver"})
    events = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(p.silver).count()
    ck = scratch_path(spark, "alert-state")
    q = (alerts_stream(silver_stream(spark, p.silver)).writeStream.format("noop")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    joins = [[o for o in pp["stateOperators"] if o["operatorName"] == "symmetricHashJoin"][0]
             for pp in q.recentProgress if pp["stateOperators"]]
    assert max(j["numRowsTotal"] for j in joins) <= events          # 1x, not 10x
    assert joins[-1]["numRowsTotal"] <= 2                            # evicted past the watermark


def test_dedup_within_watermark_and_rate_limit(spark, tmp_path):
    from voltline.streaming.medallion import dedup_within_watermark
    from voltline.streaming.sources import hub_folder_stream

    src = str(tmp_path / "tel")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("e1", t0), ("e1", t0 + dt.timedelta(seconds=5)), ("e2", t0 + dt.timedelta(seconds=9))]
    spark.createDataFrame(rows, "event_id string, event_timestamp timestamp").write.parquet(src)
    stream = spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(src)
    out = str(tmp_path / "out")
    q = (dedup_within_watermark(stream, "10 minutes").writeStream.format("parquet")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["e1", "e2"]

    # rate limit: one hub file per micro-batch
    hub = str(tmp_path / "hub")
    recs = fixture.kafka_records(I.events(spark, SF_SMALL))
    for part in range(3):
        recs.where(F.col("partition") % 3 == part).coalesce(1).write.mode("append").parquet(hub)
    files = len([f for f in __import__("os").listdir(hub) if f.endswith(".parquet")])
    q = (hub_folder_stream(spark, hub, max_files=1).writeStream.format("noop")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == files


def test_stream_sessions_merge_before_shuffle(spark, tmp_path):
    from voltline.session import apply_runtime_conf
    from voltline.streaming import jobs
    from voltline.streaming.sources import hub_folder_stream

    apply_runtime_conf(spark)
    hub = str(tmp_path / "hub")
    fixture.kafka_records(I.events(spark, SF_SMALL)).write.parquet(hub)
    q = jobs.start_sessions(hub_folder_stream(spark, hub), str(tmp_path / "out"),
                            str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    below_exchange = plan.split("Exchange hashpartitioning(device_id")[1]
    assert "MergingSessions" in below_exchange     # partial sessions built per input task
