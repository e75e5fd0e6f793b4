"""Line de-duplication with Spark's own functions.

Texts are split at newlines; a line's key is the line without ASCII white space
at its ends and with A-Z lower-cased.  Keys of at least ``MIN_CHARS`` code points
are exploded as two 64-bit hashes with their position.  Documents are counted by
hash in two steps (hash and document, then hash), both combined before the
shuffle, so a line that a third of all documents share is no hot task.  Lines of
keys in at least ``MIN_DOCS`` documents leave, but for the largest doc_id that
holds the key.  Only the positions of such lines are gathered by document; the
text that stays is put together from the runs between them, in linear time.

The table of dropped keys is broadcast after a size check, and joined by hash
beyond it (a plain table on the large side, which Spark can split at a hot key).

Defined results: a null or empty text is one empty line; a document is a doc_id:
rows that share one count once and keep their lines together; rows without an id
count as one document, which is smaller than any other; repeated rows each get
the same result; if every line leaves, the text is empty; an empty table gives
no rows; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import materialise, sized, text_hash

MIN_CHARS, MIN_DOCS = 20, 3
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"  # fixed values


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(_lines(F.translate(text, UPPER, LOWER)), lambda line: F.btrim(line, F.lit(SPACES)))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, pos (from 0), h1, h2 of every line whose key is long enough."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_key"),
                        F.posexplode(line_keys(F.col("text"))).alias("pos", "line_key"))
    return keyed.where(F.char_length("line_key") >= min_chars).select(
        "doc_id", "text_key", "pos", F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(1), "line_key").alias("h2"))


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, keeper of every key that ``min_docs`` documents hold."""
    return (lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted positions ``gone``: the runs between them."""
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.slice(
        lines, F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1)))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every row, and the columns
    in ``carry`` as ``carry_*``."""
    lines = materialise(hashed_lines(docs, min_chars), "lines")
    gone = sized(materialise(repeated_keys(lines, min_docs), "repeated-lines"))
    hits = lines.join(gone, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # a set: rows repeated in full have the same positions
    hits = hits.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).agg(
        F.array_sort(F.collect_set("pos")).alias("gone"))
    hits = sized(materialise(hits, "dropped-lines"), weight=1 + F.size("gone") / 4)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_key"), "text",
                       *(F.col(c).alias(f"carry_{c}") for c in carry))
    told = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    text = F.coalesce("text", F.lit(""))
    return told.select(
        "doc_id", F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), text).otherwise(F.array_join(_without(_lines(F.col("text")), F.col("gone")), "\n"))
        .alias("kept_text"), *(f"carry_{c}" for c in carry))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
