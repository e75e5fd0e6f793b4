"""Secret scans over a trigram inverted index.

Each rule's regular expression yields a Boolean trigram query: every group of
the query must have an alternative whose trigrams all occur.  The index maps
trigrams to documents (postings); postings are joined with the queries'
trigrams and counted, which intersects them; only candidates are then matched
with the regular expression.  A rule without mandatory trigrams scans every
text.  Trigrams fold case, so the candidates are a superset for any rule.

Only built-in Spark expressions run on the executors.

Defined results: a null text is empty and has no spans; repeated rows each get
their row; an empty table gives no rows; other columns of the input are
returned only if named in ``carry``.  Offsets count code points.
"""

from __future__ import annotations

import re._constants as C
import re._parser as sre
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import materialise, sized, text_hash

MAX_STRINGS = 64  # alternatives that a run of literals may grow to before it is cut


@dataclass(frozen=True)
class Rule:
    """``group``/``least``: a match counts if that group has so many characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The base rules and further well-known token formats.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # a run of hex digits is matched whole, so the length can be in the pattern
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
    # the header, and the body (after header fields) up to the END line where they follow
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
                r"(?:(?:[\x20\t\r\n]*(?:Proc-Type|DEK-Info):[^\n]*\n)*[A-Za-z0-9+/=\x20\t\r\n]+-----END [A-Z ]*PRIVATE KEY-----)?"),
)
RULES = BASE_RULES + MORE_RULES


# --- trigram queries ---------------------------------------------------------

def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _minimal(alternatives: set[frozenset[str]]) -> frozenset[frozenset[str]]:
    """Without alternatives that ask for all that another one asks for, and more."""
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


class _Query:
    """Walks a parsed pattern.  ``run``: the strings that the literals since the
    last gap can spell; ``groups``: alternatives that must occur."""

    def __init__(self) -> None:
        self.run: set[str] = {""}
        self.groups: list[frozenset[frozenset[str]]] = []
        self.whole = True  # the run spells all that was walked

    def gap(self) -> None:
        alternatives = {_grams(s) for s in self.run}
        if all(alternatives):
            self.groups.append(_minimal(alternatives))
        self.run, self.whole = {""}, False

    def extend(self, strings: set[str] | None) -> None:
        if strings is None or len(self.run) * len(strings) > MAX_STRINGS:
            self.gap()
            if strings is None or len(strings) > MAX_STRINGS:
                return
        self.run = {a + b for a in self.run for b in strings}

    def walk(self, nodes) -> None:
        for op, arg in nodes:
            if op is C.LITERAL:
                self.extend({chr(arg).lower()})
            elif op is C.IN:
                self.extend(_members(arg))
            elif op is C.SUBPATTERN:
                self.walk(arg[3])
            elif op is C.BRANCH:
                self.branch(arg[1])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                self.repeat(*arg)
            elif op is not C.AT:
                self.extend(None)

    def branch(self, choices) -> None:
        exact = [_strings(c) for c in choices]
        if all(e is not None for e in exact):
            return self.extend(set().union(*exact))
        self.gap()
        wanted = set()
        for c in choices:
            q = _Query()
            q.walk(c)
            q.gap()
            if not q.groups:
                return  # a choice without mandatory trigrams
            wanted |= max(q.groups, key=lambda g: min(map(len, g)))
        self.groups.append(_minimal(wanted))

    def repeat(self, least: int, most: int, item) -> None:
        one = _strings(item)
        if one is not None and (least, most) == (0, 1):
            return self.extend(one | {""})
        if one is not None:
            for _ in range(min(least, 8)):
                self.extend(one)
            if least == most <= 8:
                return
        elif least:
            self.gap()
            self.walk(item)
        self.gap()


def _members(items) -> set[str] | None:
    """Characters of a small class."""
    out: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _strings(nodes) -> set[str] | None:
    """All strings that a pattern matches, if they are few."""
    q = _Query()
    q.walk(nodes)
    return q.run if q.whole and _exact(nodes) else None


def _exact(nodes) -> bool:
    for op, arg in nodes:
        if op is C.LITERAL or op is C.AT:
            continue
        if op is C.IN and _members(arg) is not None:
            continue
        if op is C.SUBPATTERN and _exact(arg[3]):
            continue
        if op is C.BRANCH and all(_exact(c) for c in arg[1]):
            continue
        if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 1 and _exact(arg[2]):
            continue
        return False
    return True


def trigram_query(regex: str) -> list[frozenset[frozenset[str]]]:
    """Groups of alternatives of trigrams; empty: every text must be scanned."""
    q = _Query()
    q.walk(sre.parse(regex))
    q.gap()
    return q.groups


# --- index and candidates ----------------------------------------------------

def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """doc_id, text_key, trigram: which of the trigrams each text holds."""
    folded = docs.select("doc_id", text_hash().alias("text_key"), F.lower("text").alias("folded"))
    found = F.array_compact(F.array(*(F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(t)) for t in trigrams)))
    return folded.select("doc_id", "text_key", F.explode(found).alias("trigram"))


def _rows(spark: SparkSession, rows: list[tuple], **kinds: pa.DataType) -> DataFrame:
    """``rows`` as an Arrow table: a list would go through plain Python workers,
    which then stay beside those of the other operators."""
    return spark.createDataFrame(pa.table({name: pa.array([r[i] for r in rows], kind)
                                           for i, (name, kind) in enumerate(kinds.items())}))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text_key, rules: rules whose trigram query the text satisfies."""
    spark = docs.sparkSession
    clauses, groups = [], []
    for r in rules:
        query = trigram_query(r.regex)
        groups += [(r.kind, len(query))] * bool(query)
        clauses += [(r.kind, g, a, len(alt), t) for g, alts in enumerate(query)
                    for a, alt in enumerate(sorted(alts, key=sorted)) for t in alt]
    wanted = F.broadcast(_rows(spark, clauses, rule=pa.string(), grp=pa.int32(), alt=pa.int32(), wants=pa.int32(),
                               trigram=pa.string()))  # bounded by the rules
    sizes = F.broadcast(_rows(spark, groups, rule=pa.string(), n_groups=pa.int32()))
    key = ("doc_id", "text_key")
    met = (postings(docs, sorted({c[-1] for c in clauses})).join(wanted, "trigram")
           .groupBy(*key, "rule", "grp", "alt", "wants").agg(F.count_distinct("trigram").alias("has"))
           .where("has = wants")
           .groupBy(*key, "rule").agg(F.count_distinct("grp").alias("met")))
    return (met.join(sizes, "rule").where("met = n_groups")
            .groupBy(*key).agg(F.collect_set("rule").alias("rules")))


# --- spans -------------------------------------------------------------------

def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Matches of a rule as structs (start, kind_order, end): lengths of what
    lies between matches and of the matches, added up."""
    regex = F.lit(rule.regex)
    between = F.split(text, rule.regex, -1)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    size = F.transform(F.regexp_extract_all(text, regex, F.lit(rule.group)), F.length)
    parts = F.arrays_zip(F.transform(between, F.length).alias("b"), F.transform(whole, F.length).alias("m"),
                         size.alias("g"))
    empty = F.array().cast("array<struct<start:int,kind_order:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["b"]
        end = start + F.coalesce(x["m"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["g"] >= rule.least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (null: empty), spans (array of start, kind_order, end by
    start, then rule order), and the columns in ``carry`` as ``carry_*``."""
    docs = docs.select("doc_id", "text", *(F.col(c).alias(f"carry_{c}") for c in carry))
    cand = sized(materialise(candidates(docs, rules), "secret-candidates").withColumnsRenamed(
        {"doc_id": "c_doc_id", "text_key": "c_text_key"}))
    scanned = {r.kind for r in rules if not trigram_query(r.regex)}
    rows = docs.withColumn("text_key", text_hash())
    rows = rows.join(cand, F.col("doc_id").eqNullSafe(F.col("c_doc_id"))
                     & (F.col("text_key") == F.col("c_text_key")), "left")
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<start:int,kind_order:int,end:int>>")
    found = [F.when(text.rlike(r.regex) if r.kind in scanned else F.array_contains("rules", r.kind),
                    _spans(text, r, i)).otherwise(none) for i, r in enumerate(rules)]
    return rows.select("doc_id", text.alias("text"), F.array_sort(F.concat(*found)).alias("spans"),
                       *(f"carry_{c}" for c in carry))


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_order"] + 1), s["start"], s["end"])), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digests of the base rules, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind_order"] < len(BASE_RULES))
    kinds = F.transform(base, lambda s: s["kind_order"])
    count = [F.size(F.filter(kinds, lambda k: k == order)).cast("long").alias(f"n_{r.kind}")
             for order, r in enumerate(BASE_RULES)]
    return found.select("doc_id", *count, F.sha2(span_text(base, rules), 256).alias("base_sha256"),
                        span_text(F.col("spans"), rules).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones together) replaced."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                     F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
