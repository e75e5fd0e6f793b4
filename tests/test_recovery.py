"""Recovery, pruned lookups, left joins on streams, and table maintenance."""

import datetime as dt
import math
import re
import statistics
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL, telemetry_rows
from voltline.operators import keytable, maintenance, metrics, sketches
from voltline.operators.alerts import sliding_stats
from voltline.plans import inputs as I
from voltline.sources.tables import TABLES
from voltline.streaming import jobs, replay

NEW = ["throughput_series", "silver_upsert_pruned", "retention_expire", "bronze_evolving_stream", "gold_kpis_replay",
       "alerts_stream_left", "zorder_cluster", "metric_sketches"]


@pytest.mark.parametrize("name", NEW)
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    mine = sorted(tuple(repr(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols and mine
    assert mine == sorted(tuple(repr(row[names.index(c)]) for c in cols) for row in cur.fetchall())


@pytest.mark.parametrize("mean", [0.0, 1e6, 1e8, 1e9])
def test_rolling_deviation_at_large_means(spark, mean):
    values = [mean + (i * 37 % 101) / 10 for i in range(600)]
    rows = [(f"e{i}", "d1", f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}+00:00", v, False) for i, v in enumerate(values)]
    got = sliding_stats(telemetry_rows(spark, rows)).where("window_start = timestamp'2024-01-01 00:00:00'").first()
    assert got.rolling_n == 600 and math.isclose(got.rolling_std_temp, statistics.stdev(values), rel_tol=1e-6)
    assert math.isclose(got.rolling_avg_temp, statistics.fmean(values), rel_tol=1e-12)


def test_throughput_series_is_dense(spark):
    rows = [(f"e{s}", "d1", f"2024-01-01T00:{s // 60:02d}:{s % 60:02d}+00:00", 1.0, False) for s in (0, 2, 100, 101)]
    got = metrics.throughput_series(telemetry_rows(spark, rows)).orderBy("window_start").collect()
    assert len(got) == 40 and [r.events for r in got][-1] == 2 and sum(r.events for r in got) == 2
    assert got[0].window_start == got[-1].window_start - dt.timedelta(seconds=78)
    wide = metrics.throughput_series(telemetry_rows(spark, rows), points=60).collect()
    assert len(wide) == 60 and sum(r.events for r in wide) == 4
    assert metrics.throughput_series(telemetry_rows(spark, rows).limit(0)).collect() == []


def test_files_of_a_killed_batch_stay_unseen(spark, tmp_path):
    """Files that no commit lists are on disk, but neither batch nor stream readers see them."""
    recs = [r for r in E.QUERIES["gold_kpis_replay"].__globals__["_slices"](spark, SF_SMALL)]
    registry = I.registry(spark, SF_SMALL)
    p = replay.Paths.under(str(tmp_path))
    ckpt, seen = f"{p.ckpt}/silver", []

    def run():
        replay._run(jobs.start_bronze(jobs_hub(spark, p.hub), p.bronze, f"{p.ckpt}/bronze", True))
        replay._run(jobs.start_silver_sink(spark, p.bronze, p.silver, registry, ckpt, True))
        seen.append(spark.read.parquet(p.silver).count())

    replay.land(recs[0], p.hub)
    run()
    first = replay.last_batch(spark, ckpt)
    replay.land(recs[1], p.hub)
    run()
    replay.as_if_killed_before_commit(spark, ckpt, p.silver, first + 1)
    files = len(list(Path(p.silver).rglob("*.parquet")))
    assert spark.read.parquet(p.silver).count() == seen[0] < seen[1]
    run()  # writes the batch again, under new names
    assert seen[2] == seen[1] and len(list(Path(p.silver).rglob("*.parquet"))) > files
    ids = spark.read.parquet(p.silver)
    assert ids.count() == ids.select("event_id").distinct().count()


def jobs_hub(spark, hub):
    from voltline.streaming.sources import hub_folder_stream
    return hub_folder_stream(spark, hub)


def test_lookups_read_only_the_buckets_they_need(spark, tmp_path):
    path = str(tmp_path / "keys")
    old = spark.range(5000).select(F.concat(F.lit("evt-"), "id").alias("event_id"))
    keytable.write_keys(old.where("event_id < 'evt-3'"), path, 0)
    keytable.write_keys(old.where("event_id >= 'evt-3'"), path, 1)
    keytable.write_keys(old.where("event_id >= 'evt-3'"), path, 1)  # again: replaces itself
    assert spark.read.parquet(path).count() == 5000
    batch = spark.createDataFrame([("evt-7",), ("evt-4999",), ("new-1",)], "event_id string")
    needed = {r[0] for r in batch.select(keytable.key_bucket()).collect()}
    for folder in Path(path).glob("bucket=*"):  # what is not needed cannot be read at all
        if int(folder.name.split("=")[1]) not in needed:
            for f in folder.rglob("*.parquet"):
                f.write_bytes(b"not parquet")
    assert {r[0] for r in keytable.known_keys(spark, path, batch, 2).collect()} == {"evt-7", "evt-4999"}
    assert {r[0] for r in keytable.known_keys(spark, path, batch, 1).collect()} == set()
    plan = keytable.known_keys(spark, path, batch, 2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ IN", plan) and "PushedFilters: [In(event_id" in plan


def test_many_keys_are_looked_up_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keytable, "FEW_KEYS", 2)
    path = str(tmp_path / "keys")
    old = spark.range(300).select(F.concat(F.lit("evt-"), "id").alias("event_id"))
    keytable.write_keys(old, path, 0)
    batch = spark.range(290, 310).select(F.concat(F.lit("evt-"), "id").alias("event_id"))
    held = keytable.known_keys(spark, path, batch, 1)
    assert batch.join(held, "event_id", "left_anti").count() == 10


def test_expiry_is_strict_and_goes_on_after_a_crash(spark, tmp_path):
    as_of = dt.date(2024, 6, 1)
    for layer, days in (("bronze", 90), ("gold", 365)):
        ages = [0, 7, 8, 30, 31, days - 1, days, days + 1, days + 2, days + 400]
        path = str(tmp_path / layer)
        rows = [(a, as_of - dt.timedelta(days=a)) for a in ages]
        spark.createDataFrame(rows, "age int, partition_date date").write.partitionBy("partition_date").parquet(path)
        assert len(maintenance.expire(spark, path, layer, as_of, at_most=1)) == 1
        assert len(maintenance.expire(spark, path, layer, as_of)) == 2
        assert maintenance.expire(spark, path, layer, as_of) == []
        assert sorted(r.age for r in spark.read.parquet(path).collect()) == [a for a in ages if a <= days]
    plan = spark.createDataFrame([(as_of - dt.timedelta(days=a), 1) for a in (7, 8, 30, 31, 90, 91, 365, 366)],
                                 "partition_date date, rows long")
    tiers = {(r.layer, r.age_days): r.tier for r in maintenance.retention_plan(plan, as_of).collect()}
    assert [tiers["bronze", a] for a in (7, 8, 30, 31, 90, 91)] == ["hot", "cool", "cool", "archive", "archive", "delete"]
    assert [tiers["gold", a] for a in (30, 31, 365, 366)] == ["hot", "cool", "cool", "delete"]


def test_zorder_files_are_narrow_in_both_columns(spark, tmp_path):
    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("device"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) + 10**9).alias("t"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("day"))
    spans = {}
    for name, write in (("z", lambda p: maintenance.zorder_table(df, p, F.col("device"), F.col("t"), "day", 64)),
                        ("line", lambda p: maintenance.cluster(df, ["day", "device", "t"], 64).write.partitionBy("day").parquet(p))):
        path = str(tmp_path / name)
        write(path)
        files = spark.read.parquet(path).groupBy("day", F.input_file_name().alias("f")).agg(
            (F.max("device") - F.min("device")).alias("d"), (F.max("t") - F.min("t")).alias("t"), F.count("*").alias("n"))
        spans[name] = files.groupBy().agg(F.avg("d"), F.avg("t")).first()
        assert max(r["count"] for r in files.groupBy("day").count().collect()) <= 64
        assert files.agg(F.sum("n")).first()[0] == 40_000
    assert spans["z"][0] < 400 and spans["z"][1] < 400  # of 1000: narrow in both
    assert spans["line"][1] > 900  # a plain sort is narrow in its first column only


def test_sketches_merge_within_their_error(spark):
    rows = [(f"e{i}", f"d{i % 90}", f"2024-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}+00:00", 1.0, False) for i in range(4000)]
    lag = F.pmod(F.xxhash64("event_id"), F.lit(90_000_000)) + 1000
    tel = telemetry_rows(spark, rows).withColumn("kafka_timestamp", F.timestamp_micros(F.unix_micros("event_timestamp") + lag))
    exact = metrics.latency_percentiles(tel).first()
    got = sketches.merged_latencies(sketches.minute_latencies(tel)).first()
    for q in ("p50_ms", "p95_ms", "p99_ms"):
        assert math.isclose(got[q], exact[q], rel_tol=sketches.ERROR + 0.005)
    assert sketches.merged_devices(sketches.minute_devices(tel)).first()[1:] == (90, 4000)
