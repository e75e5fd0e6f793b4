"""Packing of examples into sequences by vector bin packing.

Limits hold together: tokens, segments and loss-bearing tokens of a sequence.
A sequence is filled with the pending example that fits and has the highest
dot product with the sequence's residual capacity.  When nothing fits, the
example with the highest dot product is cut to fill the rest (loss-bearing
tokens are taken to be the last of an example, so a cut's share is known);
without cuts the sequence is closed.  Examples longer than a sequence give
full sequences first.  The last sequence of a partition is cut into sequences
whose lengths are powers of two.

Each partition is packed on its own while its rows stream by (at most
``pending`` examples wait), so there is no shuffle and a lost task is simply
run again.

Defined results: a null text is empty (its end id is still packed); repeated
rows are packed as often as they occur; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import bounded_batches
from voltline.llm.tokens import END_ID, encoder, vocabulary_path

MAX_TOKENS = 4096
MAX_SEGMENTS = 512
PENDING = 1024
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long, sequence_tokens long")


class Packer:
    """Streams examples (label, ids, number of loss-bearing tokens) into
    pieces: (label, start, ids, doc_tokens, sequence, offset, loss, tokens of
    the sequence)."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                 max_loss: int | None = None, cut: bool = True, first_sequence: int = 0):
        self.cap = np.array([max_tokens, max_segments, max_loss or max_tokens], float)
        self.cut, self.sequence = cut, first_sequence
        self.waiting: list[tuple] = []  # label, ids, start, doc tokens
        self.size = np.empty((0, 3))  # tokens, segments, loss of each waiting example
        self.out: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        total, at = sum(len(p[1]) for p in pieces), 0
        for label, ids, start, doc_tokens, loss in pieces:
            self.out.append((label, start, ids, doc_tokens, self.sequence, at, loss, total))
            at += len(ids)
        self.sequence += 1

    def add(self, examples: list[tuple]) -> None:
        new, size = [], []
        for label, ids, loss in examples:
            n, start = len(ids), 0
            step = int(self.cap[0])
            while self.cut and n - start > step:
                # a full sequence, or less where its loss-bearing tokens reach the limit
                lossless = max(0, n - loss - start)
                take = min(step, lossless + int(self.cap[2]))
                self._close([(label, ids[start:start + take], start, n, max(0, take - lossless))])
                start += take
            if n - start > step or (not self.cut and loss > self.cap[2]):
                raise ValueError("an example exceeds a limit and cuts are off")
            new.append((label, ids[start:], start, n))
            size.append((n - start, 1, min(loss, n - start)))
        if new:
            self.waiting += new
            self.size = np.concatenate([self.size, np.array(size, float)])

    def drain(self, keep: int = 0) -> list[tuple]:
        """Fill sequences while more than ``keep`` examples wait."""
        if len(self.waiting) > keep:
            alive = np.ones(len(self.waiting), bool)
            left, last = len(self.waiting), keep == 0
            share = self.size / self.cap
            while left > keep:
                room, pieces = self.cap.copy(), []
                while left:
                    weight = share @ (room / self.cap)
                    fits = alive & (self.size <= room).all(axis=1)
                    best = int(np.argmax(np.where(fits, weight, -1.0)))
                    if fits[best]:
                        label, ids, start, n = self.waiting[best]
                        pieces.append((label, ids, start, n, int(self.size[best, 2])))
                        room -= self.size[best]
                        alive[best] = False
                        left -= 1
                        continue
                    best = int(np.argmax(np.where(alive, weight, -1.0)))
                    label, ids, start, n = self.waiting[best]
                    lossless = len(ids) - int(self.size[best, 2])
                    take = min(int(room[0]), lossless + int(room[2]), len(ids) - 1)
                    if not self.cut or room[1] < 1 or take < 1:
                        break
                    loss = max(0, take - lossless)
                    pieces.append((label, ids[:take], start, n, loss))
                    room -= (take, 1, loss)
                    self.waiting[best] = (label, ids[take:], start + take, n)
                    self.size[best] -= (take, 0, loss)
                    share[best] = self.size[best] / self.cap
                if last and not left:
                    self._tail(pieces)
                else:
                    self._close(pieces)
            self.waiting = [x for x, a in zip(self.waiting, alive, strict=True) if a]
            self.size = self.size[alive]
        out, self.out = self.out, []
        return out

    def _tail(self, pieces: list[tuple]) -> None:
        """The last sequence, cut at powers of two (largest first)."""
        total = sum(len(p[1]) for p in pieces)
        if not self.cut:
            return self._close(pieces)
        while total:
            want = 1 << (total.bit_length() - 1)
            total -= want
            part = []
            while want:
                label, ids, start, n, loss = pieces[0]
                take = min(want, len(ids))
                now = max(0, take - (len(ids) - loss))
                part.append((label, ids[:take], start, n, now))
                want -= take
                if take == len(ids):
                    pieces = pieces[1:]
                else:
                    pieces = [(label, ids[take:], start + take, n, loss - now), *pieces[1:]]
            self._close(part)


def pack_documents(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS,
                   max_segments: int = MAX_SEGMENTS, max_loss: int | None = None,
                   with_ids: bool = False, prompt: str | None = None) -> DataFrame:
    """One row for each piece of each document's ids (its prompt's, its text's,
    then the end id).  ``prompt``: column of instruction data whose tokens come
    first and bear no loss (null: empty); without it all tokens bear loss.
    ``max_loss`` bounds the loss-bearing tokens of a sequence.  ``with_ids`` adds
    the ids as 16-bit little-endian."""
    path = path or vocabulary_path()
    schema = SCHEMA + (", ids binary" if with_ids else "")
    bounded_batches(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        packer = Packer(max_tokens, max_segments, max_loss, first_sequence=TaskContext.get().partitionId() << 36)
        end = np.array([END_ID], "<u2")
        for batch in batches:
            ids, lead = enc.encode(batch.column(1)), enc.encode(batch.column(2)) if prompt else None
            labels = batch.column(0).to_pylist()
            lead = lead if prompt else [end[:0]] * len(labels)
            for k in range(0, len(labels), PENDING):
                some = slice(k, k + PENDING)
                packer.add([(d, np.concatenate((p, t, end)), len(t) + 1)
                            for d, p, t in zip(labels[some], lead[some], ids[some], strict=True)])
                yield from _rows(packer.drain(keep=PENDING // 2), with_ids)
        yield from _rows(packer.drain(), with_ids)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.col(prompt).alias("prompt")] if prompt else [])]
    return docs.select(*columns).mapInArrow(pack, schema)


def _rows(pieces: list[tuple], with_ids: bool) -> Iterator[pa.RecordBatch]:
    if not pieces:
        return
    label, start, ids, doc_tokens, sequence, at, loss, total = zip(*pieces, strict=True)
    cols = {"doc_id": label, "start": start, "length": [len(x) for x in ids],
            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids], "doc_tokens": doc_tokens,
            "sequence_id": sequence, "offset": at, "loss_tokens": loss, "sequence_tokens": total}
    arrays = [pa.array(v, pa.int64()) for v in cols.values()]
    names = list(cols)
    if with_ids:
        arrays.append(pa.array([x.tobytes() for x in ids], pa.binary()))
        names.append("ids")
    yield pa.RecordBatch.from_arrays(arrays, names)
