"""Write the executed (adaptive, final) physical plan of every batch query.

Usage: python scripts/explain_plans.py [sf_dir] [out.md]
Each query is collected once so AQE's final plan (join strategy, coalesced
partitions) is shown, followed by a one-line summary of exchanges, joins,
scans and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voltline.plans.catalog import QUERIES  # noqa: E402
from voltline.session import get_spark  # noqa: E402

SKIP = {n for n in QUERIES if n.endswith("_stream") or n == "bronze_schema_evolution"}


def summary(plan: str) -> str:
    if "== Initial Plan ==" in plan:
        plan = plan.split("== Initial Plan ==")[0]
    ex = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition"
                    r"|RoundRobinPartitioning\(\d+\))", plan)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)[^\n]*?(LeftOuter|LeftAnti|LeftSemi|Inner|FullOuter)?", plan)
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)))
    keys = [re.sub(r"#\d+L?", "", e) for e in ex]
    return (f"exchanges={len(ex)} {keys}; joins={[j[0] + ('/' + j[1] if j[1] else '') for j in joins]}; "
            f"cartesian={'CartesianProduct' in plan or 'NestedLoop' in plan}; pushed={pushed}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/plans.md"
    spark = get_spark("local[8]", app="voltline-plans", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    parts = [f"# Physical plans\n\nFinal adaptive plans at `{sf}` (local[8], 8 shuffle partitions), "
             "generated by `scripts/explain_plans.py`.\n"]
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        if "== Initial Plan ==" in plan:
            plan = plan.split("== Initial Plan ==")[0]
        parts.append(f"## {name}\n\n{summary(plan)}\n\n```\n{plan.strip()}\n```\n")
        print(name, summary(plan)[:160], flush=True)
    parts.extend(streaming_plans(spark, sf))
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


def streaming_plans(spark, sf):
    """Executed plans of the stateful streaming jobs, from a replay on the
    same tables (state operators, watermark predicates, exchanges)."""
    from voltline.plans import inputs as I
    from voltline.session import scratch_path
    from voltline.sources import fixture
    from voltline.streaming import jobs, replay
    from voltline.streaming.medallion import start_stream_sql
    from voltline.streaming.sources import hub_folder_stream

    p = replay.replay(spark, fixture.kafka_records(I.events(spark, sf)), I.registry(spark, sf),
                      {"bronze", "silver"}, close_windows=False, name="plans")
    root = scratch_path(spark, "stream-plans")
    starts = {
        "gold_kpis (stream)": lambda: jobs.start_gold_kpis(spark, p.silver, f"{root}/g",
                                                           f"{root}/g_ck", True),
        "alerts (stream)": lambda: jobs.start_alerts(spark, p.silver, f"{root}/a", f"{root}/a_ck", True),
        "sessions (stream)": lambda: jobs.start_sessions(hub_folder_stream(spark, p.hub), f"{root}/s",
                                                         f"{root}/s_ck", available_now=True),
        "tumbling (stream)": lambda: start_stream_sql(hub_folder_stream(spark, p.hub), f"{root}/t",
                                                      f"{root}/t_ck", True, {"tumbling"})[0],
    }
    out = ["# Streaming plans\n\nLast executed micro-batch of each stateful job "
           "(`StreamingQuery.explain`).\n"]
    with jobs.stream_partitions(spark):
        for name, start in starts.items():
            q = start()
            q.awaitTermination()
            plan = re.sub(r"#\d+L?", "", q._jsq.explainInternal(False))
            out.append(f"## {name}\n\n```\n{plan.strip()}\n```\n")
            print(name, "ok", flush=True)
    return out


if __name__ == "__main__":
    main()
