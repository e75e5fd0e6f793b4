"""Benchmark decontamination under word edits.

Texts and items are lower-cased words.  A text window of an item's size is
embedded by a CGK random walk (each step reads a word; the step's random
function of that word says whether to move on), which turns a small edit
distance into a small Hamming distance with good probability.  Bit-sampling
LSH compares a few random positions of the embeddings; it is repeated with
fresh walks as often as the target recall asks for, measured on the items
themselves under the allowed number of edits.  Every collision is verified by
the exact edit distance of the item to its best place in the text.

Only windows that could pass the verification are embedded: ``k`` edits leave
at least ``m - q + 1 - q k`` of an item's word q-grams, so a window with fewer
known q-grams cannot match.  This drops no match.

The benchmark is read in blocks of ``BLOCK`` items, each broadcast and run
against all texts, so neither its size nor the corpus is bounded; no text is
shuffled.

Items of more than ``LONG`` words are embedded in equal parts: k edits leave one
part with its share of them at most, and any part that collides leads to the
exact verification of the whole item.  Items of fewer than ``MIN_WORDS`` words,
which edits would change beyond recognition, are looked up as they are, by their
words' hash, wherever they occur.

Defined results: null or word-less texts and items match nothing; in scripts
without spaces every character is a word; a repeated row matches as often as it occurs; equal items match each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import U64, bounded_batches, mix, text_hash

# Thai and Lao, Myanmar, Khmer, kana, ideographs
SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W{SPACELESS}]+|[{SPACELESS}]")
SIMILARITY = 0.75  # 1 - edits / words of the item
RECALL = 0.995
SAMPLED = 3  # positions of an embedding that a key samples
BLOCK = 10_000  # items broadcast at once
MIN_WORDS = 8  # shorter items are looked up without edits
LONG = 64  # words of an item, beyond which its parts are embedded
RATIO = 1.2  # largest by smallest item size of a class
TRIALS, REPEATED = 12, 32  # edits of each item, and walks on each, that measure the number of repetitions
SEED = 20_240_601
SIEVE_BITS = 20
SPREAD, SHIFT = U64(0x9E3779B97F4A7C15), U64(64 - SIEVE_BITS)
SCHEMA = ("doc_id long, text_key long, item_id long, start_word long, n_item_words long, edits long, "
          "similarity double")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def edits_allowed(n: int) -> int:
    return int((1 - SIMILARITY) * n + 1e-9)


def best_place(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance of the item to any stretch of the text, and the
    first word of the leftmost such stretch."""
    m = len(text)
    cols = np.arange(m + 1)
    row, origin = np.zeros(m + 1, np.int64), cols.copy()
    for i, w in enumerate(item):
        step = row[:-1] + (text != w)
        up = row + 1
        new = up.copy()
        new[1:] = np.minimum(up[1:], step)
        start = origin.copy()
        diagonal = np.flatnonzero(step <= up[1:]) + 1
        start[diagonal] = origin[diagonal - 1]
        start[0] = 0
        new[0] = i + 1
        best = np.minimum.accumulate(new - cols)  # insertions: from the left
        source = np.maximum.accumulate(np.where(new - cols == best, cols, 0))
        row, origin = best + cols, start[source]
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end])


def _parts(n: int) -> list[tuple[int, int]]:
    """Begin and end of the parts in which ``n`` words are embedded."""
    count = -(-n // LONG)
    return [(i * n // count, (i + 1) * n // count) for i in range(count)]


@dataclass
class Lsh:
    """Repetitions of a random walk and its sampled steps."""

    salts: np.ndarray  # repetition x step: seeds of the step functions
    rows: list[np.ndarray]  # by step: the repetitions that sample it

    @classmethod
    def draw(cls, count: int, window: int, rng: np.random.Generator) -> Lsh:
        steps = max(SAMPLED, int(1.5 * window))
        sampled = np.array([rng.choice(steps, SAMPLED, replace=False) for _ in range(count)])
        last = int(sampled.max()) + 1
        return cls(rng.integers(1 << 63, size=(count, last), dtype=np.uint64),
                   [np.flatnonzero((sampled == step).any(axis=1)) for step in range(last)])


@dataclass
class SizeClass:
    """Items of similar size: what is known of them, and their LSH tables."""

    q: int
    need: int  # q-grams that a window must share
    reach: int  # positions that a window of the largest item and its edits has
    window: int  # words that are embedded
    grams: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]  # by repetition: sorted keys, item numbers
    lsh: Lsh | None = None


class Matcher:
    """A block of items, ready to be matched with texts."""

    def __init__(self, items: list[tuple[int, str | None]]):
        kept = [(i, w) for i, t in items if (w := words(t))]
        self.ids = [i for i, _ in kept]
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        self.items = [np.array([number(x, len(self.vocabulary) + 1) for x in w], np.int64) for _, w in kept]
        self.base = len(self.vocabulary) + 1
        # items by size without edits: sorted hashes of their words, item numbers
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, MIN_WORDS):
            numbers = np.array([j for j, x in enumerate(self.items) if len(x) == n], np.int64)
            if len(numbers):
                keys = np.concatenate([self.grams(self.items[j], n) for j in numbers])
                order = np.argsort(keys, kind="stable")
                self.short[n] = keys[order], numbers[order]
        # what is embedded: an item, or the parts of a long one
        self.parts = [(j, a, b) for j, x in enumerate(self.items) if len(x) >= MIN_WORDS for a, b in _parts(len(x))]
        by_size = sorted(range(len(self.parts)), key=lambda p: self.parts[p][2] - self.parts[p][1])
        self.classes: list[SizeClass] = []
        while by_size:
            least = self.parts[by_size[0]][2] - self.parts[by_size[0]][1]
            members = [p for p in by_size if self.parts[p][2] - self.parts[p][1] <= least * RATIO]
            by_size = by_size[len(members):]
            self.classes.append(self._class(members, np.random.default_rng(SEED + least)))
        self.sieves: dict[int, np.ndarray] = {}  # by q: which spread values some item's q-gram has
        for c in self.classes:
            sieve = self.sieves.setdefault(c.q, np.zeros(1 << SIEVE_BITS, bool))
            sieve[(c.grams * SPREAD) >> SHIFT] = True

    def grams(self, ids: np.ndarray, q: int) -> np.ndarray:
        n = len(ids) - q + 1
        out = np.zeros(max(n, 0), U64)
        for j in range(q if n > 0 else 0):
            out = out * U64(self.base) + ids[j:j + n].astype(U64)
        return out

    def embed(self, ids: np.ndarray, starts: np.ndarray, stops: np.ndarray, lsh: Lsh) -> np.ndarray:
        """LSH keys by (repetition, window): the words that each walk reads at
        its sampled steps; past the end of a window it reads -1."""
        at = np.repeat(starts[None, :], len(lsh.salts), axis=0)
        key = np.zeros(at.shape, U64)
        for step, rows in enumerate(lsh.rows):
            word = np.where(at < stops, ids[np.minimum(at, len(ids) - 1)], -1).astype(U64) * SPREAD
            if len(rows):
                key[rows] = mix(key[rows] ^ word[rows] + U64(step))
            at += (mix(word ^ lsh.salts[:, step, None]) & U64(1)).astype(np.int64)
        return key

    def _class(self, members: list[int], rng: np.random.Generator) -> SizeClass:
        items = [self.items[j][a:b] for j, a, b in (self.parts[p] for p in members)]
        sizes = [len(x) for x in items]
        window = min(sizes)
        q = min(max(1, n // (edits_allowed(n) + 1)) for n in sizes)
        need = max(1, min(n - q + 1 - q * edits_allowed(n) for n in sizes))
        c = SizeClass(q, need, max(n + edits_allowed(n) for n in sizes) - q + 1, window,
                      np.unique(np.concatenate([self.grams(x, q) for x in items])), [])

        def keys_of(texts: list[np.ndarray], lsh: Lsh) -> np.ndarray:
            ends = np.cumsum([len(x) for x in texts])
            starts = ends - np.array([len(x) for x in texts])
            return self.embed(np.concatenate(texts), starts, np.minimum(starts + window, ends), lsh)

        # the chance that one repetition finds an item with all the edits that are
        # allowed, of the items that are harder to find
        met, trials, chance = np.zeros(len(items)), 0, 0.0
        while trials < TRIALS or not chance and trials < 50 * TRIALS:  # until it can be told from 0
            lsh = Lsh.draw(REPEATED, window, rng)
            met += (keys_of(items, lsh) == keys_of([self._edited(x, rng) for x in items], lsh)).mean(axis=0)
            trials += 1
            chance = float(np.quantile(met / trials, 0.1))
        chance = min(max(chance, 1 / (REPEATED * trials)), 0.99)
        c.lsh = Lsh.draw(max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - chance))), window, rng)
        for keys in keys_of(items, c.lsh):
            order = np.argsort(keys, kind="stable")
            c.tables.append((keys[order], np.array(members)[order]))
        return c

    def _edited(self, item: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        out = item.tolist()
        for _ in range(edits_allowed(len(item))):
            at, kind = int(rng.integers(len(out))), int(rng.integers(3))
            out[at:at + (kind != 0)] = [0] * (kind != 1)  # insert, delete, replace
        return np.array(out or [0], np.int64)

    def known(self, ids: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By q: positions of q-grams that some item may have, and the q-grams."""
        out = {}
        for q, sieve in self.sieves.items():
            grams = self.grams(ids, q)
            at = np.flatnonzero(sieve[(grams * SPREAD) >> SHIFT])
            out[q] = at, grams[at]
        return out

    def starts(self, c: SizeClass, ids: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Starts of windows that share enough q-grams with the class."""
        hits, grams = known
        if len(hits) < c.need:
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(c.grams, grams), len(c.grams) - 1)
        hits = hits[c.grams[at] == grams]
        if len(hits) < c.need:
            return np.empty(0, np.int64)
        first, last = hits[:len(hits) - c.need + 1], hits[c.need - 1:]
        close = last - first < c.reach
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, np.maximum(last[close] - c.reach + 1, 0), 1)
        np.add.at(edge, first[close] + 1, -1)
        return np.flatnonzero(np.cumsum(edge[:-1]) > 0)

    def _short_matches(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        out = []
        for n, (keys, numbers) in self.short.items():
            grams = self.grams(ids, n)
            lo, hi = np.searchsorted(keys, grams), np.searchsorted(keys, grams, "right")
            out += [(int(j), int(s), n, 0) for s in np.flatnonzero(hi > lo) for j in numbers[lo[s]:hi[s]]
                    if (self.items[j] == ids[s:s + n]).all()]
        return out

    def match(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """item number, first word, words of the item, edits."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words(text)], np.int64)
        known = self.known(ids)
        found: dict[int, list[np.ndarray]] = {}
        for c in self.classes:
            starts = self.starts(c, ids, known[c.q])
            if not len(starts):
                continue
            found_keys = self.embed(ids, starts, np.minimum(starts + c.window, len(ids)), c.lsh)
            for mine, (keys, numbers) in zip(found_keys, c.tables, strict=True):
                lo, hi = np.searchsorted(keys, mine), np.searchsorted(keys, mine, "right")
                for s, a, b in zip(starts[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
                    for p in numbers[a:b]:
                        j, first, _ = self.parts[p]
                        found.setdefault(j, []).append(s - first)
        out = self._short_matches(ids)
        for j, at in sorted(found.items()):
            item, at = self.items[j], np.unique(at)
            n, k = len(item), edits_allowed(len(item))
            for part in np.split(at, np.flatnonzero(np.diff(at) > n) + 1):  # far apart: places of their own
                lo = max(0, int(part[0]) - k)
                edits, start = best_place(item, ids[lo:max(0, int(part[-1])) + n + 2 * k])
                if edits <= k:
                    out.append((j, lo + start, n, edits))
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each place where a text holds an item: doc_id, text_key,
    item_id, start_word, n_item_words, edits, similarity."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // BLOCK))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_key"), "text")
    kinds = (pa.int64(),) * 6 + (pa.float64(),)
    out = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        matcher = spark.sparkContext.broadcast(Matcher(sorted(map(tuple, mine.collect()), key=str)))

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            m = matcher.value
            for b in batches:
                got = [(d, key, m.ids[j], start, n, edits, 1 - edits / n)
                       for d, key, t in zip(*(c.to_pylist() for c in b.columns), strict=True)
                       for j, start, n, edits in m.match(t)]
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*got, strict=True), kinds, strict=True)],
                        [x.split()[0] for x in SCHEMA.split(", ")])

        part = rows.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out
