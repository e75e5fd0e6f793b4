"""Conversation structure repair by Wagner-Fischer alignment.

The role initials of a repaired conversation follow ``(s?(ua)+)?``.  For each
feasible length this grammar has one string (two, as a piece may start with an s
or not), so a conversation is aligned to the string of each length: Keep (0),
Rerole (2), Delete (3), Insert (2), one more for a truncated row that stays.
Lengths are tried from the most likely one outwards.  The best cost so far, the
incumbent, bounds the edits, hence the diagonals that an alignment can touch
(Ukkonen's band), and ends the search where a length alone costs more.  Each
alignment is traced back to its audit, the initials of its edits, least in ASCII
among equal ones; audits of equally cheap lengths are compared as text.

What alignment needs of a row is one letter (its role initial, upper case if
truncated; d if it must go), so a conversation is a short code.  Rows that repeat
in full are counted before the shuffle; rows are dealt and sorted by range of
(conversation, turn, role, text), so one conversation may lie in many tasks, and
are cut into pieces of at most ``PIECE`` rows.  Nearly every conversation is one
piece.  The pieces of the others are aligned from every state of the grammar to
every state; their costs, 16 numbers for ``PIECE`` rows, are added up by
conversation from the end, which tells the cheapest way through the pieces and,
among equally cheap ones, the one with the least audit.

Defined results: null roles and texts count as one space; turns are sorted with
null first, then by role and text; an initial is case sensitive; repeated rows
are duplicates; null conv_ids are one conversation; a conversation without rows
has zeros, an empty audit and the hash of the empty text; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import bounded_batches, materialise, sized

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # fixed values: costs
PIECE = 64  # rows of a conversation that are aligned at once
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # states of the grammar
STATE = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
NEVER = 1 << 60


# --- alignment ---------------------------------------------------------------

def align(code: str, target: str, limit: int, trailing: bool) -> tuple[int, str] | None:
    """Least cost and its least audit of turning ``code`` into ``target``, or
    None if it costs more than ``limit``.  ``trailing``: whether edits may
    insert behind the last row."""
    m, n = len(code), len(target)
    # x inserts and y deletes: x - y = n - m and 2x + 3y <= limit bound the diagonals j - i
    deletes = (limit - INSERT * (n - m)) // (INSERT + DELETE)
    inserts = deletes + n - m
    if deletes < 0 or inserts < 0:
        return None
    width = deletes + inserts + 1
    after = None
    table = []
    for i in range(m, -1, -1):
        row = [NEVER] * (width + 1)  # at k: target position i + k - deletes
        c = code[i] if i < m else ""
        here = c.lower()
        stays = TRUNCATED if c != here else 0
        for k in range(min(width - 1, n - i + deletes), max(0, deletes - i) - 1, -1):
            j = i + k - deletes
            best = 0 if i == m and j == n else NEVER
            if j < n and target[j] != "s" and (i < m or trailing):
                best = row[k + 1] + INSERT
            if i < m:
                if k > 0:
                    best = min(best, after[k - 1] + DELETE)
                if j < n and here != "d":
                    if here == target[j]:
                        best = min(best, after[k] + KEEP + stays)
                    elif target[j] != "s":
                        best = min(best, after[k] + REROLE + stays)
            row[k] = best
        table.append(row)
        after = row
    table.reverse()
    cost = table[0][deletes]
    if cost > limit:
        return None
    i, k, audit = 0, deletes, []
    while (j := i + k - deletes) < n or i < m:  # edits in ASCII order: D, I, then K or R
        now = table[i][k]
        if i < m and k > 0 and now == table[i + 1][k - 1] + DELETE:
            audit.append("D")
            i, k = i + 1, k - 1
        elif j < n and target[j] != "s" and (i < m or trailing) and now == table[i][k + 1] + INSERT:
            audit.append("I")
            k += 1
        else:
            audit.append("K" if code[i].lower() == target[j] else "R")
            i += 1
    return cost, "".join(audit)


def align_all(code: str, state: int, last: bool) -> dict[int, tuple[int, str]]:
    """By the grammar's state after ``code``: least cost and audit from ``state``.
    ``last``: the conversation ends here, so only complete strings count."""
    live, m = len(code) - code.count("d"), len(code)
    found: dict[int, tuple[int, str]] = {}
    for first in ("", "s") if state == START and "s" in code.lower() else ("",):
        cycle = "au" if state == AFTER_U else "ua"
        empty = state if not first else AFTER_S
        fits = max(live - len(first), 0)
        ends = {empty, STATE[cycle[0]], STATE[cycle[1]]}
        if last:
            ends &= {START, AFTER_A}
        for end in ends:
            # repeats of the cycle that end there: all of one parity, but none at all for START and AFTER_S
            if end in (START, AFTER_S):
                lengths = [0]
            else:
                odd = int(end == STATE[cycle[0]])
                lengths = range(odd if odd or end == empty else 2, m + fits + 4, 2)
            bounds = sorted((DELETE * (m - live) + INSERT * max(0, n - fits) + DELETE * max(0, fits - n), n)
                            for n in lengths)
            for least, n in bounds:
                target = first + (cycle * (n // 2 + 1))[:n]
                known = found.get(end)
                limit = known[0] if known else DELETE * m + INSERT * len(target) + TRUNCATED * m
                if known and least > limit:
                    break
                got = align(code, target, limit, last)
                if got and (not known or got < known):
                    found[end] = got
    return found


@lru_cache(maxsize=100_000)
def whole_alignment(code: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min(align_all(code, START, True).values()) if code else (0, "")


@lru_cache(maxsize=20_000)
def piece_alignment(code: str, last: bool) -> tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]:
    """Costs, audits, and the audits' order among those of one state before;
    by state before, then state after."""
    cost, audit = [NEVER] * 16, [""] * 16
    for state in range(4):
        for end, (c, a) in align_all(code, state, last).items():
            cost[4 * state + end], audit[4 * state + end] = c, a
    order = (sorted(audit[4 * state:4 * state + 4]) for state in range(4))
    rank = [ranked.index(a) for state, ranked in enumerate(order) for a in audit[4 * state:4 * state + 4]]
    return tuple(cost), tuple(audit), tuple(rank)


def repaired_turns(audit: str, state: int, code: str, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits; ``roles`` and ``texts`` are those of the
    rows of ``code`` that need not go."""
    out_roles, out_texts = [], []
    row = live = 0
    for edit in audit:
        must_go = edit != "I" and code[row] == "d"
        expected = "assistant" if state == AFTER_U else "user"
        if edit in "KR":
            out_roles.append(roles[live] if edit == "K" else expected)
            out_texts.append(texts[live])
        elif edit == "I":
            out_roles.append(expected)
            out_texts.append("")
        if edit in "KRI":
            state = STATE[out_roles[-1][0]]
        if edit != "I":
            row += 1
            live += not must_go
    return out_roles, out_texts


# --- rows --------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, drawn from a checksum of conversation and turn."""
    space = F.lit(" ")
    draw = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                               F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("draw != 0").select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("draw") == 3, 2).otherwise(1).cast("long").alias("times"))


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times (rows that are equal in all of these),
    fault of the first of them: blank, duplicate, truncated or none."""
    space, times = F.lit(" "), F.col("times") if "times" in turns.columns else F.lit(1)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        times.cast("long").alias("times"))
    rows = materialise(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times")), "turns")
    tail = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    same = [F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2")]
    rows = rows.select("*", tail.alias("tail"), *same)
    # where a role and text came first, for those that came at several turns
    first = rows.where("tail != ''").groupBy("conv_id", "t1", "t2").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("first_conv"), "t1", "t2", F.col("first.turn").alias("first_turn"),
                                        F.lit(True).alias("several"))
    first = sized(materialise(first, "first-turns"))
    same_key = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (rows.t1 == first.t1) & (rows.t2 == first.t2)
    again = F.col("several") & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = (F.when(F.col("tail") == "", "blank").when(again, "duplicate")
             .when(~F.col("tail").isin(".", "!", "?"), "truncated").otherwise("none"))
    return rows.join(first, same_key, "left").select("conv_id", "turn", "role", "text", "times", fault.alias("fault"))


# --- pieces ------------------------------------------------------------------

PIECES = ("conv_id long, pid int, seq long, code string, roles array<string>, texts array<string>, blank long, "
          "duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
          "first_turn long, last_turn long, distinct_turns long")
_FIELDS = [f.strip().split(" ")[0] for f in PIECES.split(",")]
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(),
          pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
LEGAL = {"su", "ua", "au"}


class _Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.code: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.first = self.last = None
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.distinct += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if fault != "none":
            self.count[fault] += 1
        if fault in ("blank", "duplicate"):
            self.code.append("d")
            return
        letter = initial if initial in STATE else "x"
        self.code.append(letter.upper() if fault == "truncated" else letter)
        self.roles.append(role)
        self.texts.append(text)

    def row(self, pid: int, seq: int) -> tuple:
        return (self.conv_id, pid, seq, "".join(self.code), self.roles, self.texts, *self.count.values(), self.illegal,
                self.first, self.last, self.first_turn, self.last_turn, self.distinct)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def pieces(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The conversations' rows in order, in pieces that (pid, seq) order."""
    bounded_batches(turns.sparkSession)
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        now, seq, out, held = None, 0, [], 0
        for b in batches:
            for conv_id, turn, role, text, times, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in range(times):
                    if now is None or now.conv_id != conv_id or len(now.code) >= piece:
                        if now is not None:
                            out.append(now.row(pid, seq))
                            seq += 1
                        now = _Piece(conv_id)
                        if held > 4_000_000:
                            yield _batch(out, _FIELDS, _KINDS)
                            out, held = [], 0
                    now.add(turn, role, text, fault if k == 0 or fault == "blank" else "duplicate")
                    held += 100 + len(text) * (k == 0)
        if now is not None:
            out.append(now.row(pid, seq))
        if out:
            yield _batch(out, _FIELDS, _KINDS)

    rows = faults(turns).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(rows.mapInArrow(run, PIECES), "pieces")


def _ways(pieces_: DataFrame) -> DataFrame:
    """conv_id, pid, seq, state (before the piece), cost, audit of the pieces of
    conversations in several (``last`` tells the final one)."""
    names = ["conv_id", "pid", "seq", "costs", "audits", "ranks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [piece_alignment(c, last) for c, last in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([list(c) for c, _, _ in got], pa.list_(pa.int64())),
                 pa.array([list(a) for _, a, _ in got], pa.list_(pa.string())),
                 pa.array([list(r) for _, _, r in got], pa.list_(pa.int32()))], names)

    solved = materialise(pieces_.select("conv_id", "pid", "seq", "code", "last").mapInArrow(
        run, "conv_id long, pid int, seq long, costs array<long>, audits array<string>, ranks array<int>"), "piece-costs")
    folded = solved.select("conv_id", "pid", "seq", "costs", "ranks").groupBy("conv_id").applyInPandas(
        _fold, "conv_id long, pid int, seq long, state int, next int")
    one = folded.select(F.col("conv_id").alias("f_conv"), F.col("pid").alias("f_pid"), F.col("seq").alias("f_seq"), "state", "next")
    at = 4 * F.col("state") + F.col("next")
    return solved.join(one, (solved.pid == F.col("f_pid")) & (solved.seq == F.col("f_seq"))).select(
        "conv_id", "pid", "seq", "state", F.get("costs", at).alias("cost"), F.get("audits", at).alias("audit"))


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    """The cheapest way through a conversation's pieces; of equally cheap ones,
    the one whose audit is least."""
    group = group.sort_values(["pid", "seq"])
    costs = np.stack(group["costs"].to_numpy()).reshape(-1, 4, 4)
    ranks = np.stack(group["ranks"].to_numpy()).reshape(-1, 4, 4)
    n = len(costs)
    to_go = np.full((n + 1, 4), NEVER, np.int64)
    to_go[n] = [0, NEVER, NEVER, 0]  # complete strings
    for i in range(n - 1, -1, -1):
        to_go[i] = np.minimum((costs[i] + to_go[i + 1]).min(axis=1), NEVER)
    state, states, after = START, np.zeros(n, np.int32), np.zeros(n, np.int32)
    for i in range(n):
        total = costs[i, state] + to_go[i + 1]
        best = np.flatnonzero(total == to_go[i, state])
        states[i] = state
        state = after[i] = best[np.argmin(ranks[i, state][best])]
    return pd.DataFrame({"conv_id": group["conv_id"], "pid": group["pid"], "seq": group["seq"], "state": states, "next": after})


PARTS = ("conv_id long, pid int, seq long, cost long, audit string, out_roles array<string>, out_texts array<string>")


def _edited(pieces_: DataFrame) -> DataFrame:
    """Applies each piece's audit; a piece without one is a whole conversation."""
    extra = ["blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "first_turn", "last_turn",
             "distinct_turns"]
    names = ["conv_id", "pid", "seq", "cost", "audit", "out_roles", "out_texts", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[3:9]]
            out = []
            for code, roles, texts, state, cost, audit in zip(*cols, strict=True):
                if audit is None:
                    (cost, audit), state = whole_alignment(code), START
                out.append((cost, audit, *repaired_turns(audit, state, code, roles, texts)))
            made = [pa.array([r[i] for r in out], k) for i, k in enumerate(
                (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *made, *b.columns[9:]], names)

    kinds = {"first_initial": "string", "last_initial": "string"}
    return pieces_.select("conv_id", "pid", "seq", "code", "roles", "texts", "state", "cost", "audit", *extra).mapInArrow(
        run, PARTS + "".join(f", {c} {kinds.get(c, 'long')}" for c in extra))


def repair(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The repaired conversations in pieces: conv_id, pid, seq (their order),
    several (whether the conversation has more pieces), cost, audit, out_roles,
    out_texts, and the counts of the piece's input rows."""
    cut = pieces(turns, piece)
    ends = cut.groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.struct("pid", "seq")).alias("end")).where("n > 1")
    ends = sized(materialise(ends.select(F.col("conv_id").alias("end_conv"), "end"), "piece-ends"))
    told = cut.join(ends, F.col("conv_id").eqNullSafe(F.col("end_conv")), "left").withColumn("several", F.col("end").isNotNull())
    none = [F.lit(None).cast(t).alias(c) for c, t in (("state", "int"), ("cost", "long"), ("audit", "string"))]
    whole = _edited(told.where("not several").select(cut["*"], *none)).withColumn("several", F.lit(False))
    parts = told.where("several").withColumn("last", F.col("end") == F.struct("pid", "seq"))
    ways = materialise(_ways(parts), "piece-ways").select(
        F.col("pid").alias("w_pid"), F.col("seq").alias("w_seq"), "state", "cost", "audit")
    parts = parts.join(ways, (F.col("pid") == F.col("w_pid")) & (F.col("seq") == F.col("w_seq"))).select(
        *(cut[c] for c in _FIELDS), "state", "cost", "audit")
    return whole.unionByName(_edited(parts).withColumn("several", F.lit(True)))


def _lines() -> Column:
    return F.transform(F.arrays_zip("out_roles", "out_texts"), lambda t: F.concat(t["out_roles"], F.lit(":"), t["out_texts"]))


DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def digest(repaired: DataFrame) -> DataFrame:
    """One row for each conversation.  Conversations in several pieces stream
    through their task in order; only the running hash and the audit are held."""
    text = F.array_join(_lines(), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns"), F.lit(0))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole = repaired.where("not several").select("conv_id", gaps.cast("long").alias("gaps"), *counts, "audit",
                                                 F.sha2(text, 256).alias("repaired_sha256"))
    names = [f.strip().split(" ")[0] for f in DIGEST.split(",")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def told() -> tuple:
            gaps = now["last_turn"] - now["first_turn"] + 1 - now["distinct_turns"] if now["first_turn"] is not None else 0
            return (now["conv_id"], gaps, *(now[c] for c in counts), "".join(now["audits"]), now["sha"].hexdigest())

        for b in batches:
            for r in b.to_pylist():
                if now is None or now["conv_id"] != r["conv_id"]:
                    if now is not None:
                        out.append(told())
                    now = r | {"audits": [], "sha": hashlib.sha256(), "lines": 0}
                else:
                    for c in counts:
                        now[c] += r[c]
                    now["illegal"] += now["last_initial"] + r["first_initial"] not in LEGAL
                    now["last_initial"] = r["last_initial"]
                    if r["first_turn"] is not None:
                        now["distinct_turns"] += r["distinct_turns"] - (r["first_turn"] == now["last_turn"])
                        now["last_turn"] = r["last_turn"]
                        if now["first_turn"] is None:
                            now["first_turn"] = r["first_turn"]
                now["audits"].append(r["audit"])
                if r["n_lines"]:
                    now["sha"].update((("\n" if now["lines"] else "") + r["text"]).encode("utf-8", "surrogatepass"))
                    now["lines"] += r["n_lines"]
        if now is not None:
            out.append(told())
        if out:
            yield _batch(out, names, kinds)

    order = [F.asc_nulls_first(c) for c in ("conv_id", "pid", "seq")]
    parts = repaired.where("several").select(
        "conv_id", "pid", "seq", *counts, "first_initial", "last_initial", "first_turn", "last_turn", "distinct_turns", "audit",
        F.size("out_roles").alias("n_lines"), text.alias("text"))
    parts = parts.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, DIGEST)
    return whole.unionByName(parts)


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """The contract's result: damage, repair, and one row for every conv_id."""
    told = digest(repair(damaged(turns)))
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    none = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return (ids.join(told, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("id", "conv_id")
            .fillna(none | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}))
