"""``queries()``: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the mapping in
``voltline.sources.fixture``) over their whole extent.  Outputs avoid
current_timestamp columns and nested types so that an independent engine can
reproduce them value for value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voltline.operators import alerts, gold, metrics, sessions, silver as silver_ops, streamsql
from voltline.operators import health, maintenance
from voltline.operators.joins import broadcast_if_small
from voltline.plans import inputs as I
from voltline.schemas import BRONZE_SCHEMA
from voltline.sources import fixture
from voltline.streaming.jobs import SILVER_TABLE_SCHEMA


def _rounded(df, *cols):
    """Sums of doubles depend on their order in the last digits; six decimals
    make results comparable between engines."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def q_bronze_project(spark, sf):
    return I.bronze(spark, sf)


def q_silver_parse(spark, sf):
    parsed = silver_ops.parse_and_validate(I.bronze(spark, sf))
    return parsed.select(*I.SILVER_SCALAR,
                         F.col("payload").getItem("seq").alias("payload_seq"))


def q_silver_quality(spark, sf):
    q = silver_ops.add_quality(I.telemetry(spark, sf))
    return q.select("event_id", "device_id", I.flags_text().alias("flags"),
                    F.size("quality_flags").alias("n_flags"), "is_valid")


def q_silver_enriched(spark, sf):
    s = I.silver(spark, sf)
    return s.select(*I.SILVER_SCALAR, I.flags_text().alias("flags"), "is_valid",
                    "site_name", "region", "owner_team", "sla_tier")


def q_silver_rejects(spark, sf):
    return silver_ops.rejects(I.bronze(spark, sf))


def q_silver_upsert(spark, sf):
    """Two micro-batches into an empty table: first the records that reached
    the hub before the split time, then a replay of the whole topic (which
    repeats every record and carries in-batch duplicates)."""
    b = I.bronze(spark, sf)
    reg = broadcast_if_small(I.registry(spark, sf), met=I.devices(spark, sf))  # measured once for both batches
    early = b.where(F.col("kafka_timestamp") < F.lit(I.UPSERT_SPLIT))
    table = (silver_ops.silver_upsert_rows(early, reg, None, check_size=False)
             .withColumn("batch_id", F.lit(0)))
    added = (silver_ops.silver_upsert_rows(b, reg, table.select("event_id"), check_size=False)
             .withColumn("batch_id", F.lit(1)))
    return (table.unionByName(added)
            .select("event_id", "device_id", "kafka_partition", "kafka_offset", "event_date",
                    "is_valid", "region", "batch_id"))


def q_gold_kpis(spark, sf):
    return _rounded(gold.device_kpis(I.silver(spark, sf)), "avg_temp_c", "avg_humidity", "avg_battery")


def q_asa_tumbling(spark, sf):
    return _rounded(streamsql.tumbling_by_type(I.feed(spark, sf)), "avg_temperature_c", "avg_humidity_pct", "avg_battery_pct")


def q_asa_hopping(spark, sf):
    return _rounded(streamsql.hopping_by_device(I.feed(spark, sf)), "avg_temp_c", "stddev_temp_c", "avg_pressure_hpa")


def q_asa_alerts(spark, sf):
    return streamsql.threshold_alerts(I.feed(spark, sf))


def q_asa_sessions(spark, sf):
    return sessions.device_sessions(I.feed(spark, sf))


def q_silent_devices(spark, sf):
    return sessions.silent_devices(I.telemetry(spark, sf))


def q_alerts_range(spark, sf):
    return _rounded(alerts.alerts_range(I.silver(spark, sf)), "rolling_avg_temp", "rolling_std_temp")


def q_alerts_per_event(spark, sf):
    return _rounded(alerts.alerts_per_event(I.silver(spark, sf)), "max_abs_dev")


def q_alerts_trailing(spark, sf):
    return _rounded(alerts.alerts_trailing(I.silver(spark, sf), tasks=I.tasks(spark, sf)), "trailing_avg_temp", "trailing_std_temp")


def q_throughput_series(spark, sf):
    return metrics.throughput_series(I.telemetry(spark, sf))


def q_latency_p99(spark, sf):
    return metrics.latency_percentiles(I.telemetry(spark, sf))


def q_events_today(spark, sf):
    return metrics.events_per_day(I.telemetry(spark, sf))


def q_anomaly_rate_5m(spark, sf):
    return metrics.anomaly_rate_recent(I.telemetry(spark, sf))


def q_active_devices(spark, sf):
    return metrics.active_devices(I.telemetry(spark, sf))


def q_recent_alerts(spark, sf):
    return metrics.recent_alerts(I.telemetry(spark, sf))


def q_region_throughput(spark, sf):
    return metrics.region_throughput(I.silver(spark, sf))


def q_sla_attainment(spark, sf):
    return metrics.sla_attainment(I.telemetry(spark, sf))


def q_event_log(spark, sf):
    return metrics.event_log(I.silver(spark, sf), silver_ops.rejects(I.bronze(spark, sf)))


def q_health_rollup(spark, sf):
    return health.rollup(health.device_checks(I.silver(spark, sf)))


def q_health_summary(spark, sf):
    return health.summary(health.device_checks(I.silver(spark, sf)))


def q_health_flatten(spark, sf):
    return health.flatten(health.device_checks(I.silver(spark, sf)))


def q_layer_presence(spark, sf):
    b = I.bronze(spark, sf)
    s = silver_ops.silver_upsert_rows(b, I.registry(spark, sf), None, devices=I.devices(spark, sf))
    return health.layer_presence(b, s, gold.device_kpis(s))


def q_retention_plan(spark, sf):
    parts = (I.events(spark, sf).groupBy(F.to_date("ts").alias("partition_date"))
             .agg(F.count(F.lit(1)).alias("rows")))
    return maintenance.retention_plan(parts, I.RETENTION_AS_OF)


def q_compact_cluster(spark, sf):
    s = I.silver(spark, sf).select("event_id", "device_id", "event_timestamp", "event_date",
                                   "temperature_c", "humidity_pct", "battery_pct", "is_valid",
                                   "region")
    from voltline.session import default_parallelism
    return maintenance.cluster(s, ["device_id", "event_timestamp"], default_parallelism(spark))


def _replay(spark, sf, stages, close_windows, name):
    from voltline.streaming import replay
    recs = fixture.kafka_records(I.events(spark, sf))
    return replay.replay(spark, recs, I.registry(spark, sf), stages, close_windows, name)


def q_bronze_stream(spark, sf):
    p = _replay(spark, sf, {"bronze"}, False, "bronze-stream")
    return spark.read.schema(BRONZE_SCHEMA).parquet(p.bronze).drop("ingested_at")


def q_silver_stream(spark, sf):
    p = _replay(spark, sf, {"bronze", "silver"}, False, "silver-stream")
    return (spark.read.schema(SILVER_TABLE_SCHEMA).parquet(p.silver)
            .select("event_id", "device_id", "kafka_partition", "kafka_offset", "event_date",
                    "is_valid", "region"))


def q_gold_kpis_stream(spark, sf):
    p = _replay(spark, sf, {"bronze", "silver", "gold"}, True, "gold-stream")
    return _rounded(spark.read.parquet(p.gold).drop("gold_written_at"), "avg_temp_c", "avg_humidity", "avg_battery")


def q_asa_alerts_stream(spark, sf):
    p = _replay(spark, sf, {"threshold"}, False, "threshold-stream")
    return spark.read.parquet(p.threshold)


def q_asa_sessions_stream(spark, sf):
    p = _replay(spark, sf, {"sessions"}, True, "sessions-stream")
    return spark.read.parquet(p.sessions)


def q_alerts_stream(spark, sf):
    p = _replay(spark, sf, {"bronze", "silver", "alerts"}, True, "alerts-stream")
    return _rounded(spark.read.parquet(p.alerts).drop("alert_raised_at"), "rolling_avg_temp", "rolling_std_temp")


def q_asa_tumbling_stream(spark, sf):
    p = _replay(spark, sf, {"tumbling"}, True, "tumbling-stream")
    return _rounded(spark.read.parquet(f"{p.stream_sql}/tumbling"), "avg_temperature_c", "avg_humidity_pct", "avg_battery_pct")


def q_asa_hopping_stream(spark, sf):
    p = _replay(spark, sf, {"hopping"}, True, "hopping-stream")
    return _rounded(spark.read.parquet(f"{p.stream_sql}/hopping"), "avg_temp_c", "stddev_temp_c", "avg_pressure_hpa")


def q_bronze_schema_evolution(spark, sf):
    """Bronze landed by two producer versions: records that reached the hub
    after the rollout carry an extra ``schema_version`` column.  Reading the
    folder with mergeSchema yields one table with the union of columns."""
    from voltline.operators.bronze import read_bronze
    from voltline.session import scratch_path
    root = scratch_path(spark, "bronze-evolution")
    b = I.bronze(spark, sf)
    rollout = F.col("kafka_timestamp") >= F.lit(I.UPSERT_SPLIT)
    b.where(~rollout).write.mode("append").partitionBy("event_date").parquet(root)
    (b.where(rollout).withColumn("schema_version", F.lit(2))
     .write.mode("append").partitionBy("event_date").parquet(root))
    return read_bronze(spark, root).select(
        "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "schema_version")


def q_zorder_cluster(spark, sf):
    """Silver rewritten along a Morton curve over device number and event time, and read again."""
    from voltline.session import default_parallelism, scratch_path
    path = scratch_path(spark, "zorder")
    s = I.silver(spark, sf).select("event_id", "device_id", "event_timestamp", "event_date", "temperature_c",
                                   "humidity_pct", "battery_pct", "is_valid", "region")
    device = F.substring_index("device_id", "-", -1).cast("long")
    maintenance.zorder_table(s, path, device, F.unix_micros("event_timestamp"), "event_date", default_parallelism(spark))
    return spark.read.schema(s.schema).parquet(path).select(*s.columns)


def q_metric_sketches(spark, sf):
    """Latency quantiles and distinct devices by type, merged from sketches stored by minute."""
    from voltline.operators import sketches
    from voltline.session import scratch_path
    tel, stored = I.telemetry(spark, sf), []
    for name, minutes in (("latencies", sketches.minute_latencies(tel)), ("devices", sketches.minute_devices(tel))):
        path = scratch_path(spark, f"sketch-{name}")
        minutes.write.parquet(path)
        stored.append(spark.read.schema(minutes.schema).parquet(path))
    return _rounded(sketches.merged_latencies(stored[0]).join(sketches.merged_devices(stored[1]), "device_type"),
                    "p50_ms", "p95_ms", "p99_ms")


def _slices(spark, sf, hours=(2, 4), held_every=None):
    """Hub records by arrival: before the first hour, between the hours, after
    them.  ``held_every``: events with such an id arrive hours later."""
    recs = fixture.kafka_records(I.events(spark, sf))
    at = [F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.lit(h)) for h in hours]
    ts = F.col("timestamp")
    if held_every:
        held = F.col("offset") % fixture.DUPLICATE_OFFSET % held_every == 0
        ts = F.when(held, ts + F.make_dt_interval(hours=F.lit(I.HELD_HOURS))).otherwise(ts)
    return [recs.where(ts < at[0]), *(recs.where((ts >= a) & (ts < b)) for a, b in zip(at, at[1:])), recs.where(ts >= at[-1])]


def q_gold_kpis_replay(spark, sf):
    """Gold over the Silver file sink, which dies between write and commit on the way."""
    from voltline.streaming import replay
    p = replay.replay_with_failure(spark, _slices(spark, sf), I.registry(spark, sf), "gold-replay")
    return _rounded(spark.read.parquet(p.gold).drop("gold_written_at"), "avg_temp_c", "avg_humidity", "avg_battery")


def _batch_log(spark, sf, name):
    from voltline.streaming import batchlog, replay
    return batchlog.read_log(spark, replay.replay_logged(spark, _slices(spark, sf), I.registry(spark, sf), name))


def q_batch_metrics(spark, sf):
    """What each micro-batch added to its layer, as the jobs reported it."""
    return _batch_log(spark, sf, "batch-metrics").select("layer", "n", "rows", "oldest", "newest")


def q_sla_measured(spark, sf):
    """Worst lag of each layer, measured on the batches, against its target."""
    from voltline.streaming import batchlog
    return batchlog.attainment(_batch_log(spark, sf, "sla-measured"), metrics.SLA_TARGETS)


def _gated(spark, sf, name, consumers, consume=True):
    from voltline.streaming import replay
    return replay.replay_gated(spark, _slices(spark, sf, held_every=I.HELD_EVERY), I.registry(spark, sf), name, consumers, consume)


def q_late_rows(spark, sf):
    """Rows that came after a window of theirs had closed, by consumer and window."""
    g = _gated(spark, sf, "late-rows", ["kpis", "hopping", "sessions", "alerts"], consume=False)
    parts = [g.late(c).select(F.lit(c).alias("consumer"), "event_id", "kafka_offset", "device_id", "event_timestamp", "closed_at", "mark")
             for c in g.inputs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def q_late_balance(spark, sf):
    """Rows in the results of each consumer, and rows in its late table, counted by window."""
    g = _gated(spark, sf, "late-balance", ["kpis", "hopping", "sessions"])
    counted = {"kpis": "event_count", "hopping": "event_count", "sessions": "events_in_session"}
    out = None
    for c, n in counted.items():
        kept = spark.read.parquet(g.result(c)).agg(F.coalesce(F.sum(n), F.lit(0)).alias("kept"))
        late = g.late(c).agg(F.count(F.lit(1)).alias("late"))
        row = kept.crossJoin(late).select(F.lit(c).alias("consumer"), "kept", "late")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def q_gold_kpis_gated(spark, sf):
    """KPIs of the rows that came in time, where some come hours late."""
    g = _gated(spark, sf, "kpis-gated", ["kpis"])
    return _rounded(spark.read.parquet(g.result("kpis")).drop("gold_written_at"), "avg_temp_c", "avg_humidity", "avg_battery")


def q_asa_hopping_gated(spark, sf):
    """A row that came late for some of its windows counts in the others."""
    g = _gated(spark, sf, "hopping-gated", ["hopping"])
    return _rounded(spark.read.parquet(g.result("hopping")), "avg_temp_c", "stddev_temp_c", "avg_pressure_hpa")


def q_alerts_gated(spark, sf):
    g = _gated(spark, sf, "alerts-gated", ["alerts"])
    return _rounded(spark.read.parquet(g.result("alerts")).drop("alert_raised_at"), "rolling_avg_temp", "rolling_std_temp")


def q_silver_upsert_pruned(spark, sf):
    """``silver_upsert`` with key lookups in a key table; the second batch is
    written twice, as after a failure."""
    from voltline.session import scratch_path
    from voltline.streaming.jobs import silver_upsert_batch
    root = scratch_path(spark, "silver-pruned")
    b = I.bronze(spark, sf).withColumn("ingested_at", F.col("kafka_timestamp"))
    upsert = silver_upsert_batch(spark, f"{root}/silver", I.registry(spark, sf), keys=f"{root}/keys")
    upsert(b.where(F.col("kafka_timestamp") < F.lit(I.UPSERT_SPLIT)), 0)
    upsert(b, 1)
    upsert(b, 1)
    return (spark.read.schema(SILVER_TABLE_SCHEMA).parquet(f"{root}/silver")
            .select("event_id", "device_id", "kafka_partition", "kafka_offset", "event_date", "is_valid", "region",
                    F.col("batch_id").cast("int").alias("batch_id")))


def q_alerts_stream_left(spark, sf):
    """``alerts_stream`` over a feed in which some events carry no time."""
    from voltline.streaming import replay
    recs = fixture.kafka_records(I.events(spark, sf), I.TIMELESS_EVERY)
    p = replay.replay(spark, recs, I.registry(spark, sf), {"bronze", "silver", "alerts"}, True, "alerts-left")
    return _rounded(spark.read.parquet(p.alerts).drop("alert_raised_at"), "rolling_avg_temp", "rolling_std_temp")


def q_bronze_evolving_stream(spark, sf):
    """A Bronze stream that is stopped, gets a new column, and resumes from its checkpoint."""
    from voltline.operators.bronze import read_bronze
    from voltline.streaming import jobs, replay
    from voltline.streaming.sources import hub_folder_stream
    from voltline.session import scratch_path
    p = replay.Paths.under(scratch_path(spark, "bronze-evolving"))
    recs = fixture.kafka_records(I.events(spark, sf))
    rollout = F.col("timestamp") >= F.lit(I.UPSERT_SPLIT)
    for part, extra in ((recs.where(~rollout), None), (recs.where(rollout), {"schema_version": F.lit(2)})):
        replay.land(part, p.hub)
        replay._run(jobs.start_bronze(hub_folder_stream(spark, p.hub), p.bronze, f"{p.ckpt}/bronze", True, extra))
    return read_bronze(spark, p.bronze).select(
        "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "schema_version")


def q_retention_expire(spark, sf):
    """Rows left by layer and date after the retention plan was carried out; the
    first run stops after one partition."""
    from voltline.session import scratch_path
    parts = []
    for layer in maintenance.RETENTION_RULES:
        path = scratch_path(spark, f"expire-{layer}")
        (I.events(spark, sf).withColumn("partition_date", F.to_date("ts")).write.partitionBy("partition_date").parquet(path))
        maintenance.expire(spark, path, layer, I.RETENTION_AS_OF, at_most=1)
        maintenance.expire(spark, path, layer, I.RETENTION_AS_OF)
        left = spark.read.parquet(path).groupBy("partition_date").agg(F.count(F.lit(1)).alias("rows"))
        parts.append(left.select(F.lit(layer).alias("layer"), "partition_date", "rows"))
    return parts[0].unionByName(parts[1])


QUERIES = {
    "bronze_project": q_bronze_project,
    "silver_parse": q_silver_parse,
    "silver_quality": q_silver_quality,
    "silver_enriched": q_silver_enriched,
    "silver_rejects": q_silver_rejects,
    "silver_upsert": q_silver_upsert,
    "gold_kpis": q_gold_kpis,
    "asa_tumbling": q_asa_tumbling,
    "asa_hopping": q_asa_hopping,
    "asa_alerts": q_asa_alerts,
    "asa_sessions": q_asa_sessions,
    "silent_devices": q_silent_devices,
    "alerts_range": q_alerts_range,
    "alerts_per_event": q_alerts_per_event,
    "alerts_trailing": q_alerts_trailing,
    "throughput_series": q_throughput_series,
    "latency_p99": q_latency_p99,
    "events_today": q_events_today,
    "anomaly_rate_5m": q_anomaly_rate_5m,
    "active_devices": q_active_devices,
    "recent_alerts": q_recent_alerts,
    "region_throughput": q_region_throughput,
    "sla_attainment": q_sla_attainment,
    "event_log": q_event_log,
    "health_rollup": q_health_rollup,
    "health_summary": q_health_summary,
    "health_flatten": q_health_flatten,
    "layer_presence": q_layer_presence,
    "retention_plan": q_retention_plan,
    "compact_cluster": q_compact_cluster,
    "bronze_stream": q_bronze_stream,
    "silver_stream": q_silver_stream,
    "gold_kpis_stream": q_gold_kpis_stream,
    "asa_alerts_stream": q_asa_alerts_stream,
    "asa_sessions_stream": q_asa_sessions_stream,
    "alerts_stream": q_alerts_stream,
    "asa_tumbling_stream": q_asa_tumbling_stream,
    "asa_hopping_stream": q_asa_hopping_stream,
    "bronze_schema_evolution": q_bronze_schema_evolution,
    "gold_kpis_replay": q_gold_kpis_replay,
    "silver_upsert_pruned": q_silver_upsert_pruned,
    "alerts_stream_left": q_alerts_stream_left,
    "bronze_evolving_stream": q_bronze_evolving_stream,
    "retention_expire": q_retention_expire,
    "zorder_cluster": q_zorder_cluster,
    "metric_sketches": q_metric_sketches,
    "batch_metrics": q_batch_metrics,
    "sla_measured": q_sla_measured,
    "late_rows": q_late_rows,
    "late_balance": q_late_balance,
    "gold_kpis_gated": q_gold_kpis_gated,
    "asa_hopping_gated": q_asa_hopping_gated,
    "alerts_gated": q_alerts_gated,
}
