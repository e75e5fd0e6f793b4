import os

import duckdb
import pytest

from tests.conftest import SF_CHECK, SF_SMALL, spark  # noqa: F401  (the session fixture)

# Columns that operators use inside; they must neither clash nor come back.
CLASHING = ["rep", "component", "key", "kind", "n", "row", "shard", "slot", "rule", "score", "spans", "trigram"]


@pytest.fixture(scope="session")
def edge_docs(spark):  # noqa: F811
    """Documents of the small table and hand-made edge rows: (doc_id, text, lang)."""
    rows = duckdb.connect().sql(
        f"SELECT doc_id, text, lang FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    long_text = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(70))
    rows += [
        (5001, None, "en"), (5002, "", "en"), (5003, " \n\t ", None), (5004, "one", "en"),
        (5005, "one", "en"), (5005, "one", "en"), (5005, "two words", None), (None, "no id here at all", "en"),
        (None, rows[0][1], "en"), (5006, long_text, "en"), (5007, long_text + " end", "en"),
        (5008, rows[3][1], None), (5009, rows[3][1] + " tail", "en"),
        (5010, f"lead in {passage} then out", "en"), (5011, f"other start {passage} other end", "en"),
        (5012, f"{passage} {passage}", "en"), (5013, " nbsp em \x1c sep é½ ² İstanbul ﬁ", "en"),
        (5014, "a " * 5000, "en"), (5015, "x" * 20_000, "en"), (5016, "12345 !!! ###", "de"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def edge_rows(edge_docs):
    return [(r.doc_id, r.text, r.lang) for r in edge_docs.select("doc_id", "text", "lang").collect()]


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.limit(0)


__all__ = ["SF_CHECK", "SF_SMALL", "os"]
