"""Fill-in-middle transformation with a learned rank index.

A text is a row of lines.  The index maps a rank r (a number of lines) to the
offset at which the r-th line ends, and is fitted to all boundaries of a text:
piecewise linear segments, each as long as one line through its first boundary
stays within ``ERROR`` bytes of all it covers (a cone of slopes that shrinks with
every boundary), and one residual byte for each boundary.  A cut is predicted by
its segment and corrected by the stored residual, so it is exact.

``line_index`` returns the index as a table, ``fill_in_middle`` cuts with it.
Cuts and form come from a keyed hash of the doc_id, so a lost task repeats them.

Defined results: a null text is empty; an empty text, and a text that holds one
of the sentinels, stay plain; a null doc_id is hashed as the empty string;
repeated rows get the same result; an empty table gives no rows; other columns
are ignored unless named in ``carry``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import bounded_batches

ERROR = 126  # bytes by which a segment may miss a boundary; its residual fits into one byte
SEED, RATE, SPM = 7, 100, 50  # fixed values: key of the hashes, percent transformed, percent of these in spm form
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"  # fixed values
FIRST_LOOK = 64  # boundaries that a new segment is tried on at first


class RankIndex(NamedTuple):
    """Segments (first rank, offset there, slope) and the residual of every rank."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    def at(self, rank: int) -> int:
        """The exact offset at which ``rank`` lines end."""
        k = int(np.searchsorted(self.ranks, rank, "right")) - 1
        return _predicted(self.offsets[k], self.slopes[k], rank - self.ranks[k]) + int(self.residuals[rank])


def _predicted(offset: int, slope: float, steps):
    return offset + np.floor(slope * steps + 0.5).astype(np.int64)


def fit(bounds: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of ``bounds``: ascending offsets, the first one 0."""
    ranks, slopes = [], []
    start, n = 0, len(bounds)
    while start < n:
        lo, hi, end, look = -np.inf, np.inf, start + 1, FIRST_LOOK
        while end < n:  # the cone over further boundaries, a doubled number at each look
            y = (bounds[end:end + look] - bounds[start]).astype(float)
            x = np.arange(end - start, end - start + len(y), dtype=float)
            lows = np.maximum(np.maximum.accumulate((y - error) / x), lo)
            highs = np.minimum(np.minimum.accumulate((y + error) / x), hi)
            fits = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(y)
            if fits:
                lo, hi = lows[fits - 1], highs[fits - 1]
            end += fits
            if fits < len(y):
                break
            look *= 2
        ranks.append(start)
        slopes.append((lo + hi) / 2 if end > start + 1 else 0.0)
        start = end
    first = np.array(ranks, np.int64)
    slope = np.array(slopes, float)
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    residuals = bounds - _predicted(bounds[first][of], slope[of], np.arange(n) - first[of])
    kind = np.int8 if error <= ERROR else np.int64
    return RankIndex(first, bounds[first], slope, residuals.astype(kind))


def line_bounds(raw: bytes) -> np.ndarray:
    """0 and the byte offset at which each line (with its newline) ends."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x0A) + 1
    last = [len(raw)] if raw and (not len(ends) or ends[-1] != len(raw)) else []
    return np.concatenate(([0], ends, last)).astype(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def line_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """doc_id, n, segments (rank, offset, slope) and residuals (a byte, or eight
    where ``error`` asks for more, by rank) of every row."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n long, segments array<struct<rank:long,offset:long,slope:double>>, residuals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fit(line_bounds(raw), error) for raw in _texts(b.column(1))]
            segments = [[{"rank": r, "offset": o, "slope": s} for r, o, s in zip(
                i.ranks.tolist(), i.offsets.tolist(), i.slopes.tolist(), strict=True)] for i in found]
            kind = pa.list_(pa.struct([("rank", pa.int64()), ("offset", pa.int64()), ("slope", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(i.residuals) - 1 for i in found], pa.int64()), pa.array(segments, kind),
                 pa.array([i.residuals.tobytes() for i in found], pa.binary())], ["doc_id", "n", "segments", "residuals"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12))


def _chars(raw: bytes) -> int:
    return len(raw) if raw.isascii() else int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def _cut(raw: bytes, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    index = fit(line_bounds(raw))
    n = len(index.residuals) - 1
    h1, h2, h3, h4 = _draws(doc_id, seed)
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    one, two = (index.at(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = raw[:one], raw[one:two], raw[two:]
    if h4 % 100 < spm:
        return n, "spm", _chars(prefix), _chars(middle), b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", _chars(prefix), _chars(middle), b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars (null if plain) and
    output of every row, and the columns in ``carry`` as ``carry_*``."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c).alias(f"carry_{c}") for c in carry))
    extra = docs.schema.fields[2:]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *(f.name for f in extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [_cut(raw, i, seed, rate, spm) for raw, i in zip(_texts(b.column(1)), ids, strict=True)]
            n, form, before, within, out = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                 pa.array(within, pa.int64()), pa.array(out, pa.binary()).view(pa.string()), *b.columns[2:]], names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.mapInArrow(run, ", ".join([schema, *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)]))


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone.  A transformed text holds no
    sentinel, and none can arise where it meets one, so splitting is exact."""
    psm = F.split_part(F.substring(output, 4, 2**31 - 1), F.lit("<S>"), F.lit(1))
    rest = F.split_part(output, F.lit("<S>"), F.lit(2))
    middle = F.split_part(output, F.lit("<M>"), F.lit(2))
    spm = F.split_part(F.split_part(output, F.lit("<P>"), F.lit(2)), F.lit("<M>"), F.lit(1))
    return (F.when(form == "psm", F.concat(psm, middle, F.split_part(rest, F.lit("<M>"), F.lit(1))))
            .when(form == "spm", F.concat(spm, middle, F.split_part(rest, F.lit("<P>"), F.lit(1)))).otherwise(output))


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
