import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from voltline.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_temp_c" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["silver_parse", "silver_enriched", "silver_upsert", "gold_kpis", "asa_tumbling",
        "asa_hopping", "asa_alerts", "asa_sessions", "alerts_range", "alerts_trailing",
        "health_flatten", "retention_plan", "event_log", "latency_p99"]


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    mine = sorted(tuple(repr(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    theirs = sorted(tuple(repr(row[i]) for i in idx) for row in cur.fetchall())
    assert mine == theirs
