"""Substring de-duplication by Rabin-Karp window hashes.

Every window of ``SPAN`` words has a rolling hash; the smallest doc_id in which
a hash starts is found in Spark, and a document loses the words covered by
windows that start in a smaller doc_id too.  Overlapping repeated windows merge
into maximal intervals.

Three lossless steps keep the exchanged volume small:

* documents with the same word sequence are answered by the one with the
  smallest doc_id (the others lose every word that a window covers);
* equal windows have equal minimizers (the smallest hash among their ``INNER``-
  word parts, about 7 % of all positions).  Windows whose minimizer occurs in
  one document only cannot repeat, and are not exchanged;
* only documents with a repeated minimizer are read again.

Window counting uses aggregations that combine before the shuffle and a join
back that Spark can split, so a passage in a third of all documents is no hot
task.

Defined results: null texts have no words; rows are told apart by (doc_id,
text), so repeated rows share a result; a null doc_id is larger than any
other, and null ids do not count against each other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import U64, bounded_batches, hashed_words, materialise, rolling, sized, text_hash

SPAN = 50
INNER = 25
ELEMENTS = 4_000_000  # array elements that a broadcast table may hold
LAST = (1 << 63) - 1  # stands for a null doc_id


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k consecutive values, by doubling."""
    out, have = x, 1
    while have < k:
        step = min(have, k - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def minimizers(h: np.ndarray, span: int, inner: int) -> np.ndarray:
    """The minimizer of every window of ``span`` word hashes."""
    return _sliding_min(rolling(h, inner), span - inner + 1) if len(h) >= span else np.empty(0, U64)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").split()  # of bytes: the six ASCII white spaces only


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, whole_sha256 (of all words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [_words(x) for x in _raw(b)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([_sha(w) for w in words])], ["doc_id", "text_key", "n_words", "whole_sha256"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n_words long, whole_sha256 string")


def _parts(columns: list[list[np.ndarray]], names: list[str], least: int = 0) -> Iterator[pa.RecordBatch]:
    """The collected arrays as one batch, once they hold more than ``least`` rows."""
    if columns[0] and sum(map(len, columns[0])) > least:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names)
        for c in columns:
            c.clear()


def _marks(texts: DataFrame, span: int, inner: int) -> DataFrame:
    """m, doc, text_key: each document's distinct minimizers."""
    names = ["m", "doc", "text_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for doc, key, h in zip(*_keys(b), hashed_words(_raw(b)), strict=True):
                m = np.unique(minimizers(h, span, inner)).view(np.int64)
                for column, x in zip(out, (m, np.full(len(m), doc), np.full(len(m), key)), strict=True):
                    column.append(x)
            yield from _parts(out, names)

    return texts.mapInArrow(run, "m long, doc long, text_key long")


def _raw(b: pa.RecordBatch) -> list[bytes | None]:
    return b.column(2).cast(pa.binary()).to_pylist()


def _keys(b: pa.RecordBatch) -> tuple[list, list]:
    return b.column(0).to_pylist(), b.column(1).to_pylist()


def _windows(texts: DataFrame, span: int, inner: int) -> DataFrame:
    """h, doc, text_key, pos of every window whose minimizer is repeated."""
    names = ["h", "doc", "text_key", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for b in batches:
            for doc, key, h, marks in zip(*_keys(b), hashed_words(_raw(b)), b.column(3).to_pylist(), strict=True):
                pos = np.flatnonzero(np.isin(minimizers(h, span, inner), np.array(marks, np.int64).view(U64)))
                new = (rolling(h, span)[pos].view(np.int64), np.full(len(pos), doc), np.full(len(pos), key),
                       pos.astype(np.int32))
                for column, x in zip(out, new, strict=True):
                    column.append(x)
                yield from _parts(out, names, 100_000)
        yield from _parts(out, names)

    return texts.mapInArrow(run, "h long, doc long, text_key long, pos int")


def _intervals(begins: DataFrame, span: int) -> DataFrame:
    """Repeated windows merged into maximal intervals (first word, past the last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, hi = [], []
            for begin in b.column(2).to_pylist():
                at = np.sort(np.array(begin, np.int64))
                new = np.flatnonzero(np.diff(at) > span) + 1
                lo.append(at[np.concatenate(([0], new))])
                hi.append(at[np.concatenate((new - 1, [len(at) - 1]))] + span)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lo, kind), pa.array(hi, kind)],
                                             ["doc", "text_key", "lo", "hi"])

    return begins.select("doc", "text_key", "begins").mapInArrow(
        run, "doc long, text_key long, lo array<long>, hi array<long>")


def _cut(texts: DataFrame) -> DataFrame:
    """doc, text_key, n_removed, kept_sha256, kept_text of documents that lose words."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, key, raw, lo, hi in zip(*_keys(b), _raw(b), *(c.to_pylist() for c in b.columns[3:]), strict=True):
                words = _words(raw)
                kept, at = [], 0
                for begin, end in zip(lo, hi, strict=True):
                    kept += words[at:begin]
                    at = end
                kept += words[at:]
                out.append((doc, key, len(words) - len(kept), _sha(kept), b" ".join(kept).decode()))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["doc", "text_key", "n_removed", "kept_sha256", "kept_text"])

    return texts.mapInArrow(run, "doc long, text_key long, n_removed long, kept_sha256 string, kept_text string")


def _pick(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts of the keys (doc, text_key, and more); one row for each key."""
    keys = keys.withColumnsRenamed({"text_key": "k_text"})
    return (texts.join(keys, (F.col("doc_id") == F.col("doc")) & (F.col("text_key") == F.col("k_text")))
            .drop("doc", "k_text"))


def remove_repeats(docs: DataFrame, span: int = SPAN, inner: int = INNER, with_text: bool = False) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256; ``with_text``: also
    kept_text (the kept words joined by one space; null: nothing removed)."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
                       text_hash().alias("text_key"), "text")
    rows = materialise(_whole(docs), "words")
    # the first document of each word sequence; windows of the others start in it too
    first = rows.where(F.col("n_words") >= span).groupBy("whole_sha256").agg(F.min("doc_id").alias("first_doc"))
    rows = materialise(rows.join(first, "whole_sha256", "left"), "word-rows")
    keys = materialise(rows.where("doc_id = first_doc").select(F.col("doc_id").alias("doc"), "text_key")
                       .distinct(), "word-firsts")
    texts = _pick(docs, sized(keys))
    marks = materialise(_marks(texts, span, inner).distinct(), "marks")
    # written before the join: a join of two plain tables can be split at a hot key
    shared = materialise(marks.groupBy("m").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                         .where("lo < hi").select("m"), "shared")
    again = materialise(marks.join(shared, "m", "left_semi").groupBy("doc", "text_key")
                        .agg(F.collect_list("m").alias("marks")), "shared-marks")
    windows = materialise(_windows(_pick(texts, sized(again, ELEMENTS, F.size("marks"))), span, inner), "windows")
    least = materialise(windows.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                        .where("lo < hi").select("h", "lo"), "first-windows")
    begins = windows.join(least, "h").where("doc > lo").groupBy("doc", "text_key").agg(
        F.collect_set("pos").alias("begins"))
    gone = materialise(_intervals(begins, span), "repeats")
    cut = materialise(_cut(_pick(docs, sized(gone, ELEMENTS, F.size("lo")))).dropDuplicates(["doc", "text_key"]),
                      "cut")
    is_copy = F.col("doc_id") > F.col("first_doc")
    empty = F.lit(_sha([]))
    small = cut if with_text else sized(cut.drop("kept_text"))
    out = rows.join(small.withColumnsRenamed({"text_key": "k_text"}),
                    (F.col("doc_id") == F.col("doc")) & (F.col("text_key") == F.col("k_text")), "left")
    return out.select(
        F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "text_key", "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(is_copy, empty).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        *([F.when(is_copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if with_text else []))
