"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.session import checkpoint_dir, scratch_path

# A table may be broadcast up to this many (narrow) rows; beyond it the same
# join runs as a shuffle join.
BROADCAST_ROWS = 500_000
# Arrow batches carry at most this many bytes, whatever the text length.
BATCH_BYTES = 8 * 1024 * 1024
# Python workers serve many tasks: what one has freed goes back to the system
# (Arrow's memory and large arrays at once, the rest above 8 MB) and does not
# stay beside the executor's heap until the worker ends.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
              "MALLOC_MMAP_THRESHOLD_": str(4 * 1024 * 1024), "MALLOC_TRIM_THRESHOLD_": str(8 * 1024 * 1024)}
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes so that long texts cannot fill a worker,
    let workers import this package from where the driver did, and give them
    ``WORKER_ENV`` (values that the session has set stay)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = f"{home}:{env.get('PYTHONPATH', '')}".rstrip(":")
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors, and fixes non-deterministic columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Removes the files of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    home = checkpoint_dir(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if home in folder:  # only what ``materialise`` wrote
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def file_uri(path: str) -> str:
    """``path`` as pyarrow's file systems take it."""
    return path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1)


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """Broadcast hint for a materialised table that is proven small; the plain
    table (shuffle join) otherwise.  ``weight``: what a row counts as."""
    rows = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if rows <= max_rows else df


def text_hash(text: str = "text") -> Column:
    """64-bit hash that tells null from empty text."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser (splitmix64): spreads the bits of a polynomial hash."""
    x = x.copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


# Odd multiplier of the rolling hash and its inverse mod 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=U64)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes (mod 2**64, mixed) of every window of ``k`` values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    if k <= 8:
        acc = h[:n].copy()
        for j in range(1, k):
            acc *= U64(BASE)
            acc += h[j:j + n]
        return mix(acc)
    pre = np.zeros(len(h) + 1, U64)
    np.cumsum(h * powers(BASE_INV, len(h)), dtype=U64, out=pre[1:])
    return mix((pre[k:] - pre[:-k]) * powers(BASE, n))


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(1, 257).astype(U64)
LOWERED = SAME.copy()
LOWERED[ord("A"):ord("Z") + 1] = SAME[ord("a"):ord("z") + 1]
BLOCK_BYTES = 1 << 18  # texts hashed at once, so that the arrays stay in the cache
_POWERS = [powers(BASE, 0), powers(BASE_INV, 0)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        if n > 1 << 23:  # for one very long text only
            return powers(BASE, n), powers(BASE_INV, n)
        _POWERS[:] = powers(BASE, size), powers(BASE_INV, size)
    return _POWERS[0][:n], _POWERS[1][:n]


def hashed_words(raws: list[bytes | None], lower: bool = False) -> Iterator[np.ndarray]:
    """The hashes of each text's words (runs of bytes but the six ASCII white
    spaces; ``lower`` folds A-Z): byte polynomials from prefix sums."""
    raws = [r or b"" for r in raws]
    values = LOWERED if lower else SAME
    for begin, end in chunks(np.fromiter(map(len, raws), np.int64, len(raws)), BLOCK_BYTES):
        part = raws[begin:end]
        buf = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        power, inverse = _power_tables(len(buf))
        space = SPACES[buf]
        before = np.concatenate(([True], space[:-1]))
        starts, ends = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
        sums = np.zeros(len(buf) + 1, U64)
        np.cumsum(values[buf] * power, dtype=U64, out=sums[1:])
        h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))
        edges = np.cumsum([0, *(len(r) + 1 for r in part)])
        yield from np.split(h, np.searchsorted(starts, edges[1:-1]))


def chunks(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose lengths sum to about ``limit`` (one long item may
    exceed it alone)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
