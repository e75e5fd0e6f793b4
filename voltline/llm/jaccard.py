"""N-gram Jaccard self-join with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct word shingles.  Equal
sets are answered once, by a representative.  Sets are indexed by prefix: with
all shingles in one global order (frequent ones last), two sets of Jaccard
similarity t share a shingle among their first n - ceil(t n) + 1.

Two set relations save most of the comparisons:

* skipping by position: a list's entries are sorted by set size and carry their
  position; those that size and position let link with no other entry leave the
  list, so that a shingle shared by chance mostly makes no list at all;
* answers from a similar set: every list is first compared with one pivot.
  What links to the pivot shares the pivot's component, so entries of one
  component need no comparison with each other; and by the triangle inequality
  of the Jaccard distance, entries whose distances to the pivot differ by more
  than 1 - t cannot link.

Each set also has a signature, the parity of its hashes in ``BITS`` cells.  The
bits in which two signatures differ are at most the shingles in which the sets
differ, so a pair with too many of them cannot link and is not compared; its
distance is known from below, which the triangle inequality can still use.
Pairs of large sets that pass are screened again by a wider signature.  Each
round takes the signatures of the sets it asks about, and the texts of those
that are still open after that, from the corpus once; no table of all sets or
of all signatures is broadcast for it.

For the pairs that neither relation answers, neighbours in changing orders of a
list are compared first, a linear number in each of at most ``PROBES`` rounds,
for as long as they link many; this joins groups of similar sets.  All that is
still open is listed as pairs, within blocks of a list by set size, and compared
in rounds: of any two components the pair closest by signature first, then, if
few of these link, all that no shared component has answered.
The result is exact on the hashed sets: every link between different sets is
either compared, or implied by a shared component.

Postings are exchanged as numpy blocks by shingle range, byte by byte of their
values, so that equal high bytes compress; a range holds about ``RANGE`` postings
at any corpus size, lists of several ranges with the same members are reduced to
the first of them, and a list longer than ``LONG_LIST`` is
dealt out in parts with a pivot each (the pivots are compared in turn).  Frequent shingles are those that some
task met twice; they come last in the order, so a passage that many documents
share fills no list (a shingle that is frequent in the corpus is met twice in
some task).

Defined results: null or word-less texts have no shingles and stand alone;
rows are told apart by (doc_id, text), so repeated rows share a class; a null
doc_id takes part, and a class of null ids only has a null id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltline.llm.common import (
    BROADCAST_ROWS,
    U64,
    bounded_batches,
    hashed_words,
    materialise,
    mix,
    release,
    rolling,
    sized,
    text_hash,
)
from voltline.llm.graph import components, merged

WORDS = 5
PERCENT = 75
RANGE = 400_000  # postings of one exchange block, about
LONG_LIST = 100_000  # a list that is longer is dealt out in parts
PROBES = 3  # rounds that compare neighbours before the last round, at most
YIELD = 16  # such a round is the last if it links fewer than one in so many open entries
PART = 512  # entries of a list that one window orders, about
BITS = 512  # of a signature, 64 to a long
WIDE_BITS, WIDE_FROM = 4096, 400  # of the second signature, of sets with more shingles than this
BATCH_BYTES = 2 * 1024 * 1024  # of an Arrow batch: its hashes take several times the texts
LONG_BLOCKS = 64  # a list with more open entries is compared in blocks by set size
FREQUENT = 1 << 17  # shingles that the order puts last, most frequent at the very end (1 MB broadcast)


def shingle_sets(raws: list[bytes | None], k: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; a shorter text is one."""
    for h in hashed_words(raws, lower=True):
        if len(h) >= k:
            yield np.unique(rolling(h, k))
        else:
            yield rolling(h, len(h)) ^ U64(len(h)) if len(h) else h


def _binary(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.binary()).to_pylist()


def set_sizes(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, text_key, n, set_key (hash of the whole set; null if empty), sig (its signature)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, key, sig = [], [], []
            for s in shingle_sets(_binary(b.column(2)), k):
                n.append(len(s))
                key.append(_set_key(s) if len(s) else None)
                sig.append(_signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(sig, pa.list_(pa.int64()))], ["doc_id", "text_key", "n", "set_key", "sig"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_key"), "text")
            .mapInArrow(run, "doc_id long, text_key long, n long, set_key binary, sig array<long>"))


def _set_key(s: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _signature(s: np.ndarray, bits: int = BITS) -> np.ndarray:
    odd = np.bincount((s % U64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differ() -> Column:
    """Shingles in which x and y differ, at least."""
    return sum((F.bit_count(F.col("x.sig")[i].bitwiseXOR(F.col("y.sig")[i])) for i in range(BITS // 64)), F.lit(0))


def _signatures_allow(percent: int) -> Column:
    return (100 + percent) * _differ() <= (100 - percent) * (F.col("x.n") + F.col("y.n"))


def _frequent(reps: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that some task met at least twice, the most frequent last, and
    how often such tasks met them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            met = np.concatenate(kept)
            kept.clear()
            met.sort()  # in place: only what is met twice is copied
            again = met[1:] == met[:-1]
            first, last = again.copy(), again.copy()
            first[1:] &= ~again[:-1]
            last[:-1] &= ~again[1:]
            first, last = np.flatnonzero(first), np.flatnonzero(last)
            return pa.RecordBatch.from_arrays(
                [pa.array(met[first].view(np.int64)), pa.array(last - first + 2)], ["h", "c"])

        for b in batches:
            for s in shingle_sets(_binary(b.column(0)), k):
                kept.append(s)
                size += len(s)
                if size > 2_000_000:
                    yield counted()
                    size = 0
        if kept:
            yield counted()

    top = (reps.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "h").limit(FREQUENT))  # only shapes the order: any total order is right
    got = top.toPandas().sort_values(["c", "h"])
    return got["h"].to_numpy(np.int64).view(U64), got["c"].to_numpy(np.int64)


def _ordered(s: np.ndarray, frequent: np.ndarray, by_value: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the global order: hashes ascending, then frequent ones."""
    if not len(frequent):
        return s
    at = np.minimum(np.searchsorted(by_value, s), len(by_value) - 1)
    hot = by_value[at] == s
    return np.concatenate((s[~hot], frequent[np.sort(rank[at[hot]])])) if hot.any() else s


def _salts(h: np.ndarray, rep: np.ndarray, long_lists: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Part of its list that each posting goes to; 0 for lists in one part."""
    out = np.zeros(len(h), U64)
    if len(long_lists):
        at = np.minimum(np.searchsorted(long_lists, h), len(long_lists) - 1)
        cut = long_lists[at] == h
        out[cut] = mix(rep[cut].astype(U64)) % parts[at[cut]].astype(U64)
    return out


def _planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones, and so on."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _postings(reps: DataFrame, shared, ranges: int, k: int, percent: int) -> DataFrame:
    """Prefix postings as blocks: rng, and the arrays h, rep, n, pos."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, long_lists, parts = shared.value
        rank = np.argsort(frequent, kind="stable")
        by_value = frequent[rank]
        for b in batches:
            hs, reps_, ns, ps = [], [], [], []
            for rep, s in zip(b.column(0).to_pylist(), shingle_sets(_binary(b.column(1)), k), strict=True):
                n = len(s)
                pre = n - -(-percent * n // 100) + 1
                hs.append(_ordered(s, frequent, by_value, rank)[:pre])
                reps_.append(np.full(pre, rep, np.int64))
                ns.append(np.full(pre, n, np.int32))
                ps.append(np.arange(pre, dtype=np.int32))
            if not hs:
                continue
            h, rep = np.concatenate(hs), np.concatenate(reps_)
            n, pos = np.concatenate(ns), np.concatenate(ps)
            rng = (mix(h ^ mix(_salts(h, rep, long_lists, parts))) % U64(ranges)).astype(np.int32)
            order = np.argsort(rng, kind="stable")
            h, rep, n, pos, rng = h[order], rep[order], n[order], pos[order], rng[order]
            cuts = np.flatnonzero(np.diff(rng)) + 1
            cols = [[_planes(x) for x in np.split(v, cuts)] for v in (h, rep, n, pos)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rng[np.concatenate(([0], cuts))]), *(pa.array(c, pa.binary()) for c in cols)],
                ["rng", "h", "rep", "n", "pos"])

    return reps.select("rep", "text").mapInArrow(run, "rng int, h binary, rep binary, n binary, pos binary")


# Gives rep (unique long), text of the sets in a table's w_rep, or of all for None.
Reps = Callable[[DataFrame | None], DataFrame]

# What a block gives.  PAIR: an entry to be compared with its list's pivot;
# ENTRY: an entry of a list of three or more (or of a list in parts);
# PIVOT: the pivot of one part of a list.
PAIR, ENTRY, PIVOT = 0, 1, 2
LISTS = "kind int, list_key long, pivot long, rep long, n int, pos int"


def _range_max(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The largest of values[first] to values[last], for each pair of them; the
    least number where last < first."""
    length = last - first + 1
    out = np.full(len(first), np.iinfo(np.int64).min)
    width = 1
    while len(length):
        now = np.flatnonzero((length >= width) & (length < 2 * width))
        out[now] = np.maximum(values[first[now]], values[last[now] - width + 1])
        if length.max() < 2 * width:
            break
        values = np.maximum(values[:-width], values[width:])
        width *= 2
    return out


def _partnered(listed: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Whether size and position let an entry link with any other one of its
    list, as ``_may_link`` tells.  ``listed``: the entry's list; entries come by
    list and size."""
    # the largest set that the shingles after this one (with it) can link to
    most = ((100 + percent) * (n - pos) - percent * n) // percent
    base = listed.astype(np.int64) << 32
    key, at = base + n, np.arange(len(n))
    larger = np.searchsorted(key, base + np.minimum(most, 100 * n // percent), "right") - 1
    smallest = np.searchsorted(key, base - -percent * n // 100, "left")
    smaller = np.minimum(np.searchsorted(key, base + most, "right"), at) - 1
    return (_range_max(most, at + 1, larger) >= n) | (_range_max(most, smallest, smaller) >= n)


def _lists(block: pd.DataFrame, long_lists: np.ndarray, percent: int) -> pd.DataFrame:
    h, rep, n, pos = (np.concatenate([_from_planes(x, t) for x in block[c]])
                      for c, t in (("h", U64), ("rep", np.int64), ("n", np.int32), ("pos", np.int32)))
    order = np.lexsort((rep, n, h))  # a list's entries by size: those that fit the pivot are its first ones
    h, rep, n, pos = h[order], rep[order], n[order], pos[order]
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    sizes = np.diff(np.append(starts, len(h)))
    cut = np.isin(h[starts], long_lists)
    use = (sizes > 1) | cut
    rows = np.repeat(use, sizes)
    h, rep, n, pos = h[rows], rep[rows], n[rows].astype(np.int64), pos[rows]
    sizes, cut = sizes[use], cut[use]
    # a part of a list does not tell who the others are
    listed = np.repeat(np.arange(len(sizes)), sizes)
    rows = cut[listed] | _partnered(listed, n, pos, percent)
    h, rep, n, pos, sizes = h[rows], rep[rows], n[rows], pos[rows], np.bincount(listed[rows], minlength=len(sizes))
    sizes, cut = sizes[sizes > 0], cut[sizes > 0]
    if not len(sizes):
        return pd.DataFrame({"kind": [], "list_key": [], "pivot": [], "rep": [], "n": [], "pos": []})
    starts = np.cumsum(sizes) - sizes
    pivot, pn, ppos = (np.repeat(v[starts], sizes) for v in (rep, n, pos))
    # skipped: the pivot itself, sizes too far apart, and positions after which
    # too few shingles are left (a linked pair passes where it first meets)
    need = -(-percent * (pn + n) // (100 + percent))
    fits = ((rep != pivot) & (100 * pn >= percent * n)
            & (1 + np.minimum(pn - 1 - ppos, n - 1 - pos) >= need))
    pairs = pd.DataFrame({"kind": PAIR, "list_key": 0, "pivot": pivot[fits], "rep": rep[fits], "n": n[fits],
                          "pos": pos[fits]})
    # lists with the same members ask the same questions: the first in the order does
    # (its positions tell most); parts of a list share its hash
    member = mix(rep.astype(U64) ^ U64(0x51ED270B7F3C2A11))
    key = np.where(cut, h[starts], mix(np.add.reduceat(member, starts) ^ mix(rep[starts].astype(U64))))
    open_ = (sizes > 2) | cut
    at = np.flatnonzero(open_)
    at = at[np.argsort(pos[starts[at]], kind="stable")]
    _, once = np.unique(np.where(cut[at], key[at] ^ mix(rep[starts[at]].astype(U64)), key[at]), return_index=True)
    chosen = np.zeros(len(sizes), bool)
    chosen[at[once]] = True
    rows = np.repeat(chosen, sizes)
    entries = pd.DataFrame({"kind": ENTRY, "list_key": np.repeat(key.view(np.int64), sizes)[rows],
                            "pivot": pivot[rows], "rep": rep[rows], "n": n[rows], "pos": pos[rows]})
    at = starts[cut]
    pivots = pd.DataFrame({"kind": PIVOT, "list_key": h[at].view(np.int64), "pivot": rep[at], "rep": rep[at],
                           "n": n[at], "pos": pos[at]})
    return pd.concat([pairs.drop_duplicates(["pivot", "rep"]), entries, pivots])


def _sets(reps: DataFrame, k: int, keys: list[str], made=lambda s: s.view(np.int64)) -> DataFrame:
    """``keys`` and s (what ``made`` makes of the text's set, the set itself as
    an array if not given)."""
    kinds = ", ".join(f"{c} long" for c in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [pa.array(made(s)) for s in shingle_sets(_binary(b.column(len(keys))), k)]
            sizes = np.cumsum([0, *(len(x) for x in got)]).astype(np.int32)
            flat = pa.concat_arrays(got) if got else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.ListArray.from_arrays(pa.array(sizes), flat)], [*keys, "s"])

    return reps.select(*keys, "text").mapInArrow(run, f"{kinds}, s array<long>")


def _distance_at_least(differ: Column) -> Column:
    return 1 - (F.col("total") - differ) / (F.col("total") + differ)


def _members(pairs: DataFrame) -> DataFrame:
    """w_rep: the sets of ``pairs``, each once."""
    return materialise(pairs.select(F.explode(F.array("a", "b")).alias("w_rep")).distinct(), "wanted")


def _screened(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``pairs`` of large sets, whose signatures say little, with lo and close by
    a wider signature, which only the sets of these pairs get."""
    wanted = _members(pairs)
    wide = _sets(texts.join(sized(wanted), F.col("rep") == F.col("w_rep")), k, ["rep"], lambda s: _signature(s, WIDE_BITS))
    wide = sized(materialise(wide, "wide"), weight=F.lit(WIDE_BITS // 256))
    of = {c: wide.select(F.col("rep").alias(f"{c}_rep"), F.col("s").alias(f"s{c}")) for c in "ab"}
    both = pairs.join(of["a"], F.col("a") == F.col("a_rep")).join(of["b"], F.col("b") == F.col("b_rep"))
    differ = F.aggregate(F.zip_with("sa", "sb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda x, y: x + y)
    return both.select("a", "b", "total", differ.alias("differ")).select(
        "a", "b", _distance_at_least(F.col("differ")).alias("lo"),
        ((100 + percent) * F.col("differ") <= (100 - percent) * F.col("total")).alias("close"))


def _compared(pairs: DataFrame, reps: Reps, sigs: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b, lo, hi, linked: bounds of the pairs' distances; both are the exact
    distance where the signatures allow a link.  A set travels once for each
    pair that it is the b of, and once as a, to where the pairs of a are."""
    asking = materialise(pairs.select("a", "b"), "asking")
    of_these = materialise(sigs.join(sized(_members(asking)), F.col("rep") == F.col("w_rep")).select("rep", "n", "sig"), "sigs")
    narrow = sized(of_these, weight=F.lit(BITS // 64))
    x, y = narrow.alias("x"), narrow.alias("y")
    asked = materialise(
        asking.join(x, F.col("a") == F.col("x.rep")).join(y, F.col("b") == F.col("y.rep"))
        .select("a", "b", (F.col("x.n") + F.col("y.n")).alias("total"), _differ().alias("differ"),
                _signatures_allow(percent).alias("close"), (F.least("x.n", "y.n") > WIDE_FROM).alias("large")), "asked")
    release(asking)
    release(of_these)
    # the only pass over the corpus: what follows reads the texts it found
    texts = materialise(reps(_members(asked.where("close"))), "texts")
    told = asked.withColumn("lo", _distance_at_least(F.col("differ"))).where("not (close and large)")
    pairs = materialise(told.select("a", "b", "lo", "close").unionByName(
        _screened(asked.where("close and large").select("a", "b", "total"), texts, k, percent)), "pairs")
    release(asked)
    close = sized(pairs.where("close").select("a", "b"))
    some = sized(materialise(pairs.where("close").select("a").distinct(), "paired"))
    there = _sets(texts.join(close, F.col("rep") == F.col("b")), k, ["a", "b"]).withColumnRenamed("s", "sb")
    here = _sets(texts.join(some, F.col("rep") == F.col("a")), k, ["a"]).withColumnRenamed("s", "sa")
    both = there.join(here, "a")
    union = F.size("sa") + F.size("sb") - F.col("shared")
    distance = 1 - F.col("shared") / union
    exact = both.withColumn("shared", F.size(F.array_intersect("sa", "sb"))).select(
        "a", "b", distance.alias("lo"), distance.alias("hi"),
        (100 * F.col("shared") >= percent * union).alias("linked"))
    far = pairs.where("not close").select("a", "b", "lo", F.lit(1.0).alias("hi"), F.lit(False).alias("linked"))
    answers = materialise(exact.unionByName(far), "answers")
    release(pairs)
    release(texts)
    return answers


def linked_sets(reps: Reps, sigs: DataFrame, total: int, k: int = WORDS, percent: int = PERCENT,
                long_list: int = LONG_LIST) -> DataFrame:
    """node, component over representatives.  ``reps``: as of ``_representatives``;
    ``sigs``: rep, n, sig."""
    every = reps(None)
    frequent, counts = _frequent(every, k)
    is_long = counts > long_list
    order = np.argsort(frequent[is_long])
    long_lists = frequent[is_long][order]
    parts = (1 + counts[is_long] // long_list)[order]
    shared = every.sparkSession.sparkContext.broadcast((frequent, long_lists, parts))
    ranges = max(16, -(-total * (100 - percent) // 100 // RANGE))
    blocks = _postings(every, shared, ranges, k, percent).repartition(ranges, "rng")
    lists = materialise(blocks.groupBy("rng").applyInPandas(
        lambda block: _lists(block, shared.value[1], percent), LISTS), "lists")

    # first round: every entry with its pivot, and the pivots of one list's parts with the least
    heads = lists.where(F.col("kind") == PIVOT)
    least = heads.groupBy("list_key").agg(F.min(F.struct("n", "pivot")).alias("head"))
    among = heads.join(least, "list_key").where("pivot != head.pivot").select(
        F.col("head.pivot").alias("a"), F.col("pivot").alias("b"))
    first = lists.where(F.col("kind") == PAIR).select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    answers = _compared(first.unionByName(among).distinct(), reps, sigs, k, percent)
    # lists of one key have the same members: the first in the order has each one's least position
    entries = lists.where(F.col("kind") == ENTRY).groupBy("list_key", "pivot", "rep", "n").agg(F.min("pos").alias("pos"))
    found = components(answers.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))

    # what the pivots left open
    known = answers.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), "lo", "hi")
    entries = materialise(_open(entries, found).join(known, ["pivot", "rep"], "left"), "open-entries")
    for turn in range(PROBES):
        still = entries.count()
        if not still:
            return found
        linked = _links(_neighbours(entries, turn, percent), reps, sigs, k, percent)
        links = linked.count()
        if links:
            found = merged(found, linked)
            entries = materialise(_open(entries.drop("component", "members"), found), "open-entries")
        if links * YIELD < still:
            break

    # last rounds: every pair of entries of one list in different components; a
    # pair with several lists is taken from the first one it shares
    mine = entries.groupBy(F.col("rep").alias("l_rep")).agg(
        F.transform(F.array_sort(F.collect_set(F.struct("pos", "list_key"))), lambda e: e["list_key"]).alias("lists"))
    entries = materialise(entries.join(mine, entries.rep == mine.l_rep).drop("l_rep")
                          .join(sigs.select("rep", "sig"), "rep"), "open-entries")
    entries = entries.select(
        "list_key", "pivot", "rep", "n", "pos", "component", F.col("lo").cast("float"), F.col("hi").cast("float"), "lists", "sig",
        F.when(F.col("members") > LONG_BLOCKS, _block(F.col("n"), percent)).alias("block"))
    # blocks of a long list by size: the smaller set of a pair lies in the larger one's block or the one below
    x = entries.withColumn("block", F.coalesce("block", F.lit(-1))).alias("x")
    y = entries.withColumn("block", F.explode(F.when(F.col("block").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.array("block", F.greatest(F.col("block") - 1, F.lit(0))))).alias("block")).alias("y")
    first_shared = F.element_at(F.array_intersect("x.lists", "y.lists"), 1)
    one_pivot = F.col("x.pivot") == F.col("y.pivot")
    apart = F.greatest(F.col("x.lo") - F.col("y.hi"), F.col("y.lo") - F.col("x.hi")) > 1 - percent / 100 + 1e-6
    answered = one_pivot & ((F.col("x.rep") == F.col("x.pivot")) | (F.col("y.rep") == F.col("y.pivot"))
                            | F.coalesce(apart, F.lit(False)))
    smaller = F.struct("x.n", "x.rep") < F.struct("y.n", "y.rep")
    rest = (x.join(y, (F.col("x.list_key") == F.col("y.list_key")) & (F.col("x.block") == F.col("y.block")))
            .where(smaller & (F.col("x.component") != F.col("y.component"))
                   & _may_link(percent) & _signatures_allow(percent) & ~answered & (first_shared == F.col("x.list_key")))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.component").alias("ca"),
                    F.col("y.component").alias("cb"), _differ().alias("d")).distinct())
    rest = materialise(rest, "rest")
    # of two components, the closest pair by signature goes first: once it links, the others need no comparison
    for _ in range(PROBES):
        first = rest.groupBy(F.least("ca", "cb").alias("c1"), F.greatest("ca", "cb").alias("c2")).agg(
            F.min_by(F.struct("a", "b"), F.struct("d", "a", "b")).alias("p"))
        first = materialise(first.select("p.*"), "first-pairs")
        asked = first.count()
        if not asked:
            return found
        links = _links(first, reps, sigs, k, percent)
        found = merged(found, links)
        by_a, by_b = (found.select(F.col("node").alias(n), F.col("component").alias(c)) for n, c in (("a", "na"), ("b", "nb")))
        done, rest = rest, materialise(
            rest.join(sized(first), ["a", "b"], "left_anti").join(by_a, "a", "left").join(by_b, "b", "left")
            .select("a", "b", F.coalesce("na", "ca").alias("ca"), F.coalesce("nb", "cb").alias("cb"), "d")
            .where("ca != cb"), "rest")
        release(done)
        if links.count() * YIELD < asked:
            break
    return merged(found, _links(rest.select("a", "b"), reps, sigs, k, percent))


def _block(n: Column, percent: int) -> Column:
    """Sizes in steps of 100 / percent: linked sets lie in one block or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / np.log(100 / percent) + 1e-9)


def _links(pairs: DataFrame, reps: Reps, sigs: DataFrame, k: int, percent: int) -> DataFrame:
    """u, v: the pairs that link."""
    return _compared(pairs, reps, sigs, k, percent).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _open(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of the lists that lie in several components, with component and
    the list's number of entries."""
    labelled = (entries.join(found, entries.rep == found.node, "left")
                .withColumn("component", F.coalesce("component", "rep")).drop("node"))
    several = materialise(labelled.groupBy("list_key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
        .where("lo != hi").select("list_key", "members"), "open-lists")
    return labelled.join(several, "list_key")


def _may_link(percent: int) -> Column:
    """Sizes of x and y, and the shingles after the shared one (with it), allow a link."""
    left = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return ((100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
            & ((100 + percent) * left >= percent * (F.col("x.n") + F.col("y.n"))))


def _neighbours(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs a, b: each entry with the next one of its list in an order that
    changes by turn, if they lie in different components.  Similar sets soon
    share a component this way, for a number of comparisons that is linear in
    the list.  Long lists are ordered in parts."""
    order = F.xxhash64("rep", F.lit(turn))
    part = F.pmod(F.xxhash64("rep", F.lit(-1 - turn)), F.floor(F.col("members") / PART) + 1)
    window = Window.partitionBy("list_key", part).orderBy(order)
    nxt = F.lead(F.struct("rep", "component", "n", "pos")).over(window)
    paired = entries.withColumn("y", nxt).where(F.col("y").isNotNull() & (F.col("component") != F.col("y.component")))
    x = paired.select(F.struct("rep", "n", "pos").alias("x"), "y")
    return x.where(_may_link(percent)).select(
        F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def _representatives(rows: DataFrame, texts: DataFrame, chosen: DataFrame) -> Reps:
    """A function that gives rep, text of the sets in w_rep of a table, or of all
    if it gets none.  Texts move only if the table of representatives is too
    large to broadcast; of rows repeated in full, one is taken."""
    same = (F.col("doc_id").eqNullSafe(F.col("c_doc_id"))) & (F.col("text_key") == F.col("c_text_key"))
    again = materialise(rows.groupBy("doc_id", "text_key").count().where("count > 1")
                        .select(F.col("doc_id").alias("c_doc_id"), F.col("text_key").alias("c_text_key")), "again")
    repeated = not again.isEmpty()

    def found(chosen: DataFrame) -> DataFrame:
        if not repeated:
            return texts.join(sized(chosen), same).select("rep", "text")
        twice = F.col("chosen.c_doc_id").eqNullSafe(F.col("again.c_doc_id")) & (
            F.col("chosen.c_text_key") == F.col("again.c_text_key"))
        pair = chosen.alias("chosen"), sized(again).alias("again")
        once = materialise(pair[0].join(pair[1], twice, "left_anti"), "reps-once")
        more = materialise(pair[0].join(pair[1], twice, "left_semi"), "reps-again")
        return texts.join(sized(once), same).select("rep", "text").unionByName(
            texts.join(sized(more), same).select("rep", "text").dropDuplicates(["rep"]))

    every = found(chosen)
    if chosen.count() > BROADCAST_ROWS:
        every = materialise(every, "representatives")
        return lambda wanted: every if wanted is None else every.join(
            sized(wanted), F.col("rep") == F.col("w_rep")).select("rep", "text")
    # the few that are asked for are looked up first, so that they alone are broadcast
    return lambda wanted: every if wanted is None else found(materialise(
        chosen.join(sized(wanted), F.col("rep") == F.col("w_rep")).drop("w_rep"), "reps-wanted"))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT,
                    long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, and component_key (text_key of
    the component's first row: smallest doc_id, null last, then smallest
    text_key): one row for each row."""
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    rows = materialise(set_sizes(docs, k), "set-sizes")
    # one representative for each distinct set
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    classes = materialise(rows.where("n > 0").groupBy("set_key").agg(
        F.min(first).alias("one"), F.max("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("rep", F.monotonically_increasing_id()), "set-classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    chosen = classes.select(F.col("one.doc_id").alias("c_doc_id"), F.col("one.text_key").alias("c_text_key"), "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_key"), "text")
    reps = _representatives(rows, texts, chosen)
    parts = linked_sets(reps, classes.select("rep", "n", "sig"), total, k, percent, long_list)
    # the first row of each component, then of each class, then of each row
    ids = classes.join(parts, classes.rep == parts.node, "left").withColumn(
        "component", F.coalesce("component", "rep"))
    least = ids.groupBy("component").agg(F.min("one").alias("least"))
    by_class = ids.join(least, "component").select("set_key", "least")
    alone = F.col("least").isNull()  # no shingles
    return (rows.join(by_class, "set_key", "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                    F.when(alone, F.col("text_key")).otherwise(F.col("least.text_key")).alias("component_key")))
