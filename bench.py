"""Benchmark: headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; the best run is reported).  Each query is executed
in full through the no-op sink (nothing is collected to the driver).  One
batch query and one small streaming replay run first as untimed warm-up.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voltline.plans.catalog import QUERIES  # noqa: E402
from voltline.session import get_spark  # noqa: E402

# Batch queries timed as-is; streaming replays (which write their tables)
# run once each.
BATCH = ["silver_parse", "silver_enriched", "silver_rejects", "silver_upsert", "gold_kpis",
         "asa_tumbling", "asa_hopping", "asa_alerts", "asa_sessions", "silent_devices",
         "alerts_range", "alerts_per_event", "alerts_trailing", "throughput_series",
         "latency_p99", "events_today", "anomaly_rate_5m", "active_devices", "recent_alerts",
         "region_throughput", "sla_attainment", "event_log", "health_rollup",
         "health_summary", "health_flatten", "layer_presence", "retention_plan",
         "compact_cluster", "bronze_project"]
STREAMS = ["silver_stream", "gold_kpis_stream", "alerts_stream", "asa_sessions_stream"]


def sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [a for a in sys.argv[1:] if a in QUERIES]
    spark = get_spark(f"local[{cpus}]", app="voltline-bench", shuffle_partitions=max(8, cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up, not reported: one batch query (JIT, codegen) and, when
    # streaming queries are timed, one streaming replay (streaming classes,
    # state store) on the smallest scale factor next to the benched one
    run(spark, "gold_kpis", sf_dir)
    if not only or any(n in STREAMS for n in only):
        small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
        run(spark, "asa_sessions_stream", small if os.path.isdir(small) else sf_dir)
    times = {}
    for name in (only or BATCH):
        if name in STREAMS:
            continue
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    for name in (only or STREAMS):
        if name in STREAMS:
            times[name] = round(run(spark, name, sf_dir), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    out = {"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf_of(sf_dir), "cpus": cpus, "events": events,
           "repeat": repeat}
    # throughput views of the same runs (the reference states events/s)
    rates = {}
    if times.get("silver_parse"):
        rates["silver_parse_events_per_sec"] = round(events / times["silver_parse"])
    if times.get("gold_kpis"):
        rates["gold_kpis_events_per_sec"] = round(events / times["gold_kpis"])
    if times.get("gold_kpis_stream"):
        rates["stream_bronze_to_gold_events_per_sec"] = round(events / times["gold_kpis_stream"])
    out["throughput"] = rates
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
