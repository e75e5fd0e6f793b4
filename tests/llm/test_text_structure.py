"""Fill-in-middle, conversation repair and line de-duplication against
brute-force versions over the small table and edge rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_operators import ascii_lower, same
from voltline.llm import conversations, fim, lines

SPACES = " \t\n\x0b\x0c\r"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- 11 fill-in-middle -------------------------------------------------------

def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def lined_docs(spark, edge_docs):
    """The edge documents and texts with lines, sentinels and repeated keys."""
    shared = "A line that three documents share, at least"
    rows = [
        (6001, "a<P>b\nc"), (6002, "x\n<S>"), (6003, "<M>"), (6004, "ends in <\nS> and <\n"), (6005, "\n"), (6006, "\n\n\n"),
        (6007, "é\nü\n😀\nend"), (6008, "\n".join(f"{i % 7 * 'w'} {i}" for i in range(9000))), (6009, "<S\nP>\n<\n"),
        (6010, f"{shared}\nown\n{shared.upper()}"), (6011, f"\t{shared} \r\nother"), (6012, f"{shared}\x0b"),
        (6012, f"again\n{shared}"), (6012, f"again\n{shared}"), (None, f"{shared}\nx"), (None, f"y\n{shared}\n"),
        (6013, "nineteen characters\nnineteen characters"), (6014, "nineteen characters"), (6015, "nineteen characters"),
        (6016, "ÀÉÎ twenty characters\n"), (6017, "àéî twenty characters"), (6018, "ÀÉÎ Twenty Characters"),
        (6019, " nbsp stays part of the key"), (6020, "nbsp stays part of the key"), (6021, "\n".join([shared] * 5000)),
    ]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    clash = [F.lit("clash").alias(c) for c in ("lines", "gone", "form", "n", "pos", "h1", "keeper", "output")]
    return edge_docs.select("doc_id", "text").unionByName(more).select("*", *clash).repartition(3)


@pytest.fixture(scope="module")
def lined_rows(lined_docs):
    return [tuple(r) for r in lined_docs.select("doc_id", "text").collect()]


def test_fill_in_middle(lined_docs, lined_rows):
    got = fim.fill_in_middle(lined_docs, carry=("text",))
    want = [(d, t, *brute_fim(d, t)) for d, t in lined_rows]
    same([(r.doc_id, r.carry_text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got.collect()], want)
    assert {w[3] for w in want} == {"plain", "spm", "psm"}
    told = got.select("carry_text", fim.restored(F.col("output"), F.col("form")).alias("again")).collect()
    assert all(r.again == (r.carry_text or "") for r in told)
    same([(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.digest(got).collect()],
         [(w[0], sha(w[6]), sha(w[1] or "")) for w in want])


def test_fill_in_middle_rates(lined_docs):
    forms = [r.form for r in fim.fill_in_middle(lined_docs, rate=0).collect()]
    assert set(forms) == {"plain"}
    forms = [r.form for r in fim.fill_in_middle(lined_docs, spm=100).collect()]
    assert set(forms) == {"plain", "spm"}


@pytest.mark.parametrize("error", [0, 3, 126, 1000])
def test_rank_index_is_exact_and_bounded(error):
    rnd = np.random.default_rng(5)
    for steps in ([], [1], [7] * 900, rnd.integers(1, 200, 5000), [1] * 40 + [30_000] + [2] * 300, rnd.integers(1, 9, 70)):
        bounds = np.concatenate(([0], np.cumsum(np.asarray(steps, np.int64)))).astype(np.int64)
        index = fim.fit(bounds, error)
        assert [index.at(r) for r in range(len(bounds))] == bounds.tolist()
        assert np.abs(index.residuals.astype(int)).max() <= error + 1
    assert len(fim.fit(np.arange(0, 7 * 901, 7), error).ranks) == 1  # equal lines are one segment


def test_line_index(lined_docs, lined_rows):
    index = fim.line_index(lined_docs).collect()
    assert len(index) == len(lined_rows)
    by_n = sorted(r.n for r in index)
    assert by_n == sorted(len(re.findall("[^\n]*\n|[^\n]+", t or "")) for _, t in lined_rows)
    long = next(r for r in index if r.doc_id == 6008)
    assert len(long.residuals) == 9001 and len(long.segments) < 200
    made = fim.RankIndex(*(np.array([s[c] for s in long.segments]) for c in ("rank", "offset", "slope")),
                         np.frombuffer(long.residuals, np.int8))
    text = next(t for d, t in lined_rows if d == 6008)
    assert [made.at(r) for r in (0, 1, 4500, 9000)] == [len("".join(text.splitlines(True)[:r])) for r in (0, 1, 4500, 9000)]


def test_fill_in_middle_empty(empty_docs):
    assert fim.digest(fim.fill_in_middle(empty_docs)).collect() == []


# --- 12 conversations --------------------------------------------------------

def brute_damage(rows):
    """By conv_id: (turn, role, text) after damage; every conv_id is there."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(named.encode()) % 20
        mine = out[conv]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        mine += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(r, key=lambda t: (t[0] is not None, t)) for c, r in out.items()}


def brute_repair(rows):
    """Cheapest edits by a shortest path over (row, state) with audits as second key."""
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.strip(SPACES)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
    after = {"s": 1, "u": 2, "a": 3}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            break
        nxt = (3, "assistant") if state == 2 else (2, "user")
        heapq.heappush(heap, (cost + 2, audit + "I", i, nxt[0], (*out, f"{nxt[1]}:")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            _, role, text = rows[i]
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                first = role[:1]
                if first in after and (after[first] == nxt[0] or (first == "s" and state == 0)):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after[first], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, nxt[0], (*out, f"{nxt[1]}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(rows, rows[1:], strict=False)
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in pairs), cost, audit, sha("\n".join(out)))


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def random_turns(seed, conversations_, most):
    rnd = random.Random(seed)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "User", "", None]
    texts = ["Yes.", "No.", "Cut of", " ", "", None, "Why?", "é!", "x. \n"]
    rows = []
    for c in range(conversations_):
        for t in range(rnd.randint(1, most)):
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"Text {rnd.randint(0, 10**6)}{rnd.choice('.!?x')}"
            rows.append((rnd.choice([c, c, c, c, None]) if c == 0 else c, rnd.choice([t, t, t, t + 3, None, -t]),
                         rnd.choice(roles), text))
    return rows + rows[:7]


def repaired(df):
    return [tuple(r[c] for c in COLUMNS) for r in conversations.repaired_conversations(df).collect()]


def test_conversations_of_the_table(spark):
    rows = duckdb.connect().sql(f"SELECT * FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    got = repaired(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    same(got, [(c, *brute_repair(r)) for c, r in brute_damage(rows).items()])
    assert {letter for g in got for letter in g[7]} == set("KRDI")


def test_random_conversations(spark):
    rows = random_turns(3, 400, 12)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("clash"), "seq": F.lit(1), "audit": F.lit("x")})
    same(repaired(df.repartition(5)), [(c, *brute_repair(r)) for c, r in brute_damage(rows).items()])


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_long_conversations_in_pieces(spark, piece):
    rnd = random.Random(piece)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", "bot"]), f"{rnd.choice(['A', 'B', f'Line {t}'])}{rnd.choice('.!x')}")
            for c, n in ((1, 300), (2, 70), (3, 5), (None, 90)) for t in range(n)]
    rows += [(4, None, "user", "The same row.")] * 500 + [(4, 1, "assistant", "End.")]
    told = conversations.digest(conversations.repair(spark.createDataFrame(rows, SCHEMA).repartition(4), piece))
    want = defaultdict(list)
    for c, *r in rows:
        want[c].append(tuple(r))
    same([tuple(r[c] for c in COLUMNS) for r in told.collect()],
         [(c, *brute_repair(sorted(r, key=lambda t: (t[0] is not None, t)))) for c, r in want.items()])


def test_alignment_stays_within_its_limit():
    assert conversations.align("uau", "uaua", 2, True) == (2, "KKKI")
    assert conversations.align("uau", "uaua", 1, True) is None
    assert conversations.align("uau", "uaua", 99, False) == (4, "KKIR")
    assert conversations.align("dU", "ua", 99, True) == (6, "DKI")
    assert conversations.whole_alignment("sua") == (0, "KKK")
    assert conversations.whole_alignment("s") == (3, "D")
    assert conversations.whole_alignment("dd") == (6, "DD")


def test_conversations_edges(spark):
    rows = [(1, None, None, None), (2, 5, "user", "Hi."), (2, 9, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    same(repaired(df), [(c, *brute_repair(r)) for c, r in brute_damage(rows).items()])
    assert repaired(df.limit(0)) == []


# --- 13 lines ----------------------------------------------------------------

def brute_lines(rows):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    held = defaultdict(set)
    for d, parts in split:
        for line in parts:
            held[ascii_lower(line.strip(SPACES))].add(d)
    gone = {k: max(x for x in ds if x is not None) for k, ds in held.items() if len(k) >= 20 and len(ds) >= 3}
    for d, parts in split:
        kept = [x for x in parts if gone.get(ascii_lower(x.strip(SPACES)), d) == d]
        yield d, len(parts), len(parts) - len(kept), "\n".join(kept)


def test_lines(lined_docs, lined_rows):
    want = list(brute_lines(lined_rows))
    kept = lines.drop_repeated_lines(lined_docs, carry=("text",))
    same([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in kept.collect()], want)
    same([tuple(r) for r in lines.digest(kept).collect()], [(d, n, k, sha(t)) for d, n, k, t in want])
    by_id = defaultdict(list)
    for d, n, k, t in want:
        by_id[d].append((n, k, t))
    assert by_id[6010] == [(3, 2, "own")] and by_id[6021] == [(5000, 0, "\n".join(["A line that three documents share, at least"] * 5000))]
    assert by_id[6014] == [(1, 0, "nineteen characters")] and (2, 1, "again") in by_id[6012]


def test_lines_by_shuffle_join(lined_docs, lined_rows, monkeypatch):
    monkeypatch.setattr(lines, "sized", lambda df, **_: df)
    got = lines.drop_repeated_lines(lined_docs)
    same([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()], list(brute_lines(lined_rows)))


def test_lines_use_only_sql_functions(lined_docs):
    kept = lines.drop_repeated_lines(lined_docs)
    plan = kept._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_lines_empty(empty_docs):
    assert lines.digest(lines.drop_repeated_lines(empty_docs)).collect() == []
