"""Training-order materialisation.

Token sequences of one fixed length get a global slot by a keyed Feistel
permutation of 0..N-1 (cycle-walking back into the range), so the order is
random, needs no sort of random keys, and can be recomputed or inverted from
the key alone.  Slots are cut into shards of equal count; each shard is one
binary file of fixed-stride records, so a reader seeks to
``(slot % per_shard) * stride`` and resumes anywhere.

A shard is written by one task in slot order under a temporary name and then
renamed, so a task that runs twice leaves one file with the same bytes.

Defined results: a null text is empty (only its end id); repeated rows are
written as often as they occur; an empty table gives no files and no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from voltline.llm.common import U64, bounded_batches, materialise, mix, release
from voltline.llm.tokens import END_ID, encoder, vocabulary_path

STRIDE = 2048  # tokens of a record
PER_SHARD = 2048  # records of a shard file
ROUNDS = 6
MANIFEST = "manifest.json"
INDEX = "sequence_id long, slot long, shard long, byte_offset long, n_tokens int, crc32 long, doc_ids array<long>"


def _half_bits(n: int) -> int:
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def _feistel(x: np.ndarray, bits: int, key: int, inverse: bool) -> np.ndarray:
    mask = U64((1 << bits) - 1)
    left, right = x >> U64(bits), x & mask
    for r in (reversed(range(ROUNDS)) if inverse else range(ROUNDS)):
        salt = mix(np.array([(key * (2 * r + 1) + r) & (2**64 - 1)], U64))[0]
        if inverse:
            left, right = right ^ (mix(left ^ salt) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ salt) & mask)
    return (left << U64(bits)) | right


def permute(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Bijection of 0..n-1 chosen by ``key``: the cipher is applied again to
    whatever falls outside the range."""
    bits = _half_bits(n)
    out = _feistel(x.astype(U64), bits, key, inverse)
    while (far := out >= U64(n)).any():
        out[far] = _feistel(out[far], bits, key, inverse)
    return out.astype(np.int64)


def sequences(docs: DataFrame, path: str | None = None, stride: int = STRIDE) -> DataFrame:
    """Documents' ids (end id after each) in a row, cut at every ``stride``
    ids; the last sequence of a partition is filled with end ids."""
    path = path or vocabulary_path()
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, count = encoder(path), TaskContext.get().partitionId(), 0
        squeeze = ZstdCompressor(level=1).compress  # on their way to the shard, ids take a third less
        end = np.array([END_ID], "<u2")
        flat, owners, starts = np.empty(0, "<u2"), [], np.empty(0, np.int64)

        def rows(full: int, last: int) -> pa.RecordBatch:
            edge = np.arange(full) * stride
            lo = np.searchsorted(starts, edge, "right") - 1
            hi = np.searchsorted(starts, np.minimum(edge + stride, len(flat)), "left")
            ids = flat[:full * stride]
            if last:
                ids = np.concatenate((ids, np.full(stride - last, END_ID, "<u2")))
            sizes = [stride] * (full - bool(last)) + [last] * bool(last)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * full, pa.int32()), pa.array(range(count, count + full), pa.int64()),
                 pa.array(sizes, pa.int32()),
                 pa.array([owners[a:b] for a, b in zip(lo, hi, strict=True)], pa.list_(pa.int64())),
                 pa.array([squeeze(ids[k * stride:(k + 1) * stride].tobytes()) for k in range(full)], pa.binary())],
                ["part", "idx", "n_tokens", "doc_ids", "ids"])

        for batch in batches:
            parts = [p for x in enc.encode(batch.column(1)) for p in (x, end)]
            sizes = np.fromiter((len(x) + 1 for x in parts[::2]), np.int64, len(parts) // 2)
            starts = np.concatenate((starts, len(flat) + np.cumsum(sizes) - sizes))
            owners += batch.column(0).to_pylist()
            flat = np.concatenate((flat, *parts))
            full = len(flat) // stride
            if full:
                yield rows(full, 0)
                count += full
                flat = flat[full * stride:]
                keep = max(0, int(np.searchsorted(starts, full * stride, "right")) - 1) if len(flat) else len(owners)
                owners, starts = owners[keep:], np.maximum(starts[keep:] - full * stride, 0)
        if len(flat):
            yield rows(1, len(flat))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        cut, "part int, idx long, n_tokens int, doc_ids array<long>, ids binary")


def write_order(seqs: DataFrame, out: str, key: int, per_shard: int = PER_SHARD, stride: int = STRIDE) -> DataFrame:
    """Write the shard files of ``seqs`` (materialised: part, idx, n_tokens,
    doc_ids, compressed ids) under ``out``; returns the index, one row a sequence."""
    from pyarrow.fs import FileSystem

    spark = seqs.sparkSession
    counts = sorted((r[0], r[1]) for r in seqs.groupBy("part").count().collect())  # a row for each input task
    total = sum(c for _, c in counts)
    width = 2 * stride  # bytes of a record
    firsts, at = [], 0
    for part, c in counts:
        firsts.append((part, at))
        at += c
    fs, root = FileSystem.from_uri(out)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
        f.write(json.dumps({"records": total, "stride": width, "per_shard": per_shard, "key": key,
                            "rounds": ROUNDS}).encode())
    offsets = spark.createDataFrame(firsts, "part int, first long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("sequence_id").to_numpy()
            slots = permute(ids, total, key)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(slots), pa.array(slots // per_shard)],
                [*b.schema.names, "slot", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = FileSystem.from_uri(out)
        task = TaskContext.get().taskAttemptId()
        current, stream, temp = -1, None, ""
        unsqueeze = ZstdDecompressor().decompress

        def close() -> None:
            stream.close()
            disk.move(temp, f"{root}/{shard_name(current)}")

        for b in batches:
            shards, ids = b.column("shard").to_pylist(), [unsqueeze(x) for x in b.column("ids").to_pylist()]
            for s, x in zip(shards, ids, strict=True):
                if s != current:
                    if stream:
                        close()
                    current, temp = s, f"{root}/.{shard_name(s)}.{task}"
                    stream = disk.open_output_stream(temp)
                stream.write(x)
            slots = b.column("slot").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("sequence_id"), b.column("slot"), b.column("shard"),
                 pa.array((slots % per_shard) * width), b.column("n_tokens"),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64()), b.column("doc_ids")],
                ["sequence_id", "slot", "shard", "byte_offset", "n_tokens", "crc32", "doc_ids"])
        if stream:
            close()

    bounded_batches(spark)
    numbered = (seqs.join(F.broadcast(offsets), "part")
                .select((F.col("first") + F.col("idx")).alias("sequence_id"), "n_tokens", "doc_ids", "ids")
                .mapInArrow(number, "sequence_id long, n_tokens int, doc_ids array<long>, ids binary, "
                                    "slot long, shard long"))
    tasks = max(1, -(-total // per_shard))
    # a partition is one range of slots, the shard itself: no task has two, none is left without
    return (numbered.repartitionById(tasks, F.col("shard").cast("int")).sortWithinPartitions("slot")
            .mapInArrow(write, INDEX))


def shard_name(shard: int) -> str:
    return f"shard-{shard:07d}.bin"


def read_slots(out: str, first: int, count: int) -> np.ndarray:
    """``count`` records from slot ``first`` on, read sequentially (a resume
    needs no more than the slot reached)."""
    from pyarrow.fs import FileSystem

    fs, root = FileSystem.from_uri(out)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        m = json.loads(f.read())
    parts, slot, stop = [], first, min(first + count, m["records"])
    while slot < stop:
        shard, at = divmod(slot, m["per_shard"])
        n = min(m["per_shard"] - at, stop - slot)
        with fs.open_input_file(f"{root}/{shard_name(shard)}") as f:
            parts.append(np.frombuffer(f.read_at(n * m["stride"], at * m["stride"]), "<u2"))
        slot += n
    return np.concatenate(parts).reshape(-1, m["stride"] // 2) if parts else np.empty((0, 0), "<u2")


def training_order(docs: DataFrame, out: str, key: int, path: str | None = None, stride: int = STRIDE,
                   per_shard: int = PER_SHARD) -> DataFrame:
    """Tokenise, number, permute and write ``docs``; the index is the result."""
    seqs = materialise(sequences(docs, path, stride), "sequences")
    index = materialise(write_order(seqs, out, key, per_shard, stride), "order-index")
    release(seqs)
    return index
