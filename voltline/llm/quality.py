"""Quality rules: text statistics and n-gram perplexity.

The language model is a modified Kneser-Ney character model of order 4 for
each language, over the words of each text with one space between them and a
mark before and after, so that n-grams reach across words.  It is trained on
all texts of the language but those labelled bad; texts labelled good weigh 1,
texts without a label ``GOOD_TEXTS / (GOOD_TEXTS + good texts of the language)``,
so that junk among them teaches the less, the more texts are known to be good.
Spark counts the n-grams: each task reduces its texts to distinct n-grams, and
an aggregation adds them up.  A document's score is its mean negative log probability by character.

A document is kept if no base rule fails and its score lies in its language's
band, which spans the middle half of all texts' scores, widened by ``BAND``
times its length (``FLOOR`` at least) on both sides, and more for short texts,
whose scores vary more: text unlike the language (symbols, capitals, other
languages) and text that is too predictable leave.  With labels, ``fit_bounds``
chooses the lower and the upper width of each language on the labelled texts.  Copies of a text in one
language count as one text in the model and in the band.

Aggregations and joins over the full n-gram table estimate the model, whatever
its size (``estimates``).  It is written to the shared checkpoint folder as
sorted arrays in parts by hash; a task reads the parts that its texts' n-grams
fall into.

Defined results: a null text has no words, and fails; a null language is a
language of its own; repeated rows are each scored and judged; an empty
table gives no rows; other columns are returned only if named in ``carry``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltline.llm.common import U64, bounded_batches, chunks, file_uri, materialise, rolling, sized, text_hash
from voltline.session import scratch_path

ORDER = 4
BITS = U64(16)  # of an n-gram's character (UTF-16 unit)
PART_ROWS = 50_000  # n-grams in a part of the model
HELD_ROWS = 4_000_000  # n-grams that a task keeps in memory; further parts are read again
PRIME = 1_000_003  # deals n-grams over the parts
BAND = 3.5
FLOOR = 0.01  # least length of a band's middle half
GOOD_TEXTS = 5.0  # good texts of a language at which a text without a label weighs half
STEPS, PER_UNIT, PRIOR = 40, 4, 50.0  # grid of the fitted bounds (up to 10 units), weight of all languages' labels
SHORT = 3.0  # the band of a text of n words is wider by the factor 1 + SHORT / sqrt(n)
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5  # fixed values of the base rules
SYMBOLS = "#*$%&|<>"
WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
COUNT_BYTES = 2 * 1024 * 1024  # of an Arrow batch while n-grams are counted
CHARACTERS = 500_000  # that a task holds before it reduces them to n-grams, or scores at once


# --- counting ----------------------------------------------------------------

def _units(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order-4 keys of the words in a row, the number of each word's
    predictions (its characters and the end mark), and the first one's place."""
    parts = [f"\0\0 {w} " for w in words]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = "".join(parts).encode("utf-16-le", "surrogatepass")
    codes = np.frombuffer(raw, "<u2").astype(U64)
    if len(codes) != sizes.sum():  # characters of two units
        sizes = np.fromiter((len(p.encode("utf-16-le", "surrogatepass")) // 2 for p in parts), np.int64, len(parts))
    keys = codes.copy()
    for j in range(1, ORDER):
        keys[j:] |= codes[:-j] << (BITS * U64(j))
    starts = np.cumsum(sizes) - sizes
    predicted = np.ones(len(codes), bool)
    for j in range(ORDER - 1):
        predicted[starts + j] = False
    return keys[predicted], sizes - (ORDER - 1), np.cumsum(sizes - (ORDER - 1)) - (sizes - (ORDER - 1))


def _lang() -> Column:
    return F.coalesce("lang", F.lit("")).alias("lang")


def weighted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """lang, text, weight in the model: the copies of a text in one language
    share the weight of one text; a text labelled bad weighs 0."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lang(), text_hash().alias("text_key"))
    texts = (_labelled(keyed, labels).groupBy("lang", "text_key")
             .agg(F.count("*").alias("copies"), F.min("quality").alias("quality")))
    texts = materialise(texts, "texts")
    langs = sized(materialise(texts.groupBy("lang").agg(
        (GOOD_TEXTS / (GOOD_TEXTS + F.count_if(F.col("quality") == 1))).alias("usual")), "langs"))
    weight = F.when(F.col("quality") == 1, 1.0).when(F.col("quality") == 0, 0.0).otherwise(F.col("usual")) / F.col("copies")
    unusual = texts.join(langs, "lang").select("lang", "text_key", weight.alias("weight"), "usual")
    unusual = sized(materialise(unusual.where("weight != usual").drop("usual"), "weights"))
    return (docs.select(_lang(), "text", text_hash().alias("text_key")).join(unusual, ["lang", "text_key"], "left")
            .join(langs, "lang").select("lang", "text", F.coalesce("weight", "usual").alias("weight")))


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with their label: 1 good, 0 bad, or null."""
    if labels is None:
        return rows.withColumn("quality", F.lit(None).cast("int"))
    one = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    return rows.join(one, "doc_id", "left")


def _flat(words: list[str]) -> str:
    return " ".join(words)


def ngram_counts(docs: DataFrame, across: bool = False) -> DataFrame:
    """lang, g (order-4 key), c: n-gram counts over all documents, each counted
    ``weight`` times if there is such a column; within words, or ``across`` them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def reduced() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                if not counter:
                    continue
                keys, sizes, _ = _units(list(counter))
                values, inverse = np.unique(keys, return_inverse=True)
                weight = np.repeat(np.fromiter(counter.values(), float, len(counter)), sizes)
                c = np.bincount(inverse, weight, len(values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values)), pa.array(values.view(np.int64)), pa.array(c)], ["lang", "g", "c"])
            held.clear()

        size = 0
        for b in batches:
            for lang, text, weight in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if text:
                    counter = held.setdefault(lang, Counter())
                    found = WORD.findall(text)
                    for w in [_flat(found)] * bool(found) if across else found:
                        size += len(w) * (w not in counter)
                        counter[w] += weight
                if size > CHARACTERS:
                    yield from reduced()
                    size = 0
        yield from reduced()

    weight = F.col("weight") if "weight" in docs.columns else F.lit(1.0)
    return (docs.select(_lang(), "text", weight.alias("weight")).mapInArrow(run, "lang string, g long, c double")
            .groupBy("lang", "g").agg(F.round(F.sum("c")).cast("long").alias("c")))  # parts of copies add up to whole counts


# --- model -------------------------------------------------------------------

class Model:
    """Modified Kneser-Ney estimates as sorted arrays; ``counts``: order-4 keys
    (sorted) and counts of one language.  The form of ``estimates`` for a table
    that fits into memory; it also scores n-grams that are not in the table."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys: list[np.ndarray] = []  # by order 1..4
        self.logp: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []  # by order 1..4, of order - 1 characters
        self.logb: list[np.ndarray] = []
        grams = [(keys, counts)]
        for n in range(ORDER - 1, 0, -1):  # lower orders count distinct left neighbours
            grams.insert(0, np.unique(grams[0][0] & U64((1 << (16 * n)) - 1), return_counts=True))
        self.unseen = -np.log(len(grams[0][0]) + 1.0)
        for n, (g, a) in enumerate(grams, 1):
            d = discounts(a)[np.minimum(a, 3) - 1]
            context, inverse = np.unique(g >> BITS, return_inverse=True)
            total = np.bincount(inverse, a)
            backoff = np.bincount(inverse, d) / total
            lower = np.exp(self._lower(g, n))
            p = (a - d) / total[inverse] + backoff[inverse] * lower
            self.keys.append(g)
            self.logp.append(np.log(p).astype(np.float32))
            self.contexts.append(context)
            self.logb.append(np.log(np.maximum(backoff, 1e-12)).astype(np.float32))

    def _lower(self, g: np.ndarray, n: int) -> np.ndarray:
        if n == 1:
            return np.full(len(g), self.unseen)
        return self.score(g & U64((1 << (16 * (n - 1))) - 1), n - 1)

    def score(self, g: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log probability of each key's last character after the others."""
        out = np.empty(len(g))
        todo = np.arange(len(g))
        add = np.zeros(len(g))
        for m in range(n, 0, -1):
            keys = self.keys[m - 1]
            now = g[todo] & U64((1 << (16 * m)) - 1)
            at = np.minimum(np.searchsorted(keys, now), len(keys) - 1)
            seen = keys[at] == now
            out[todo[seen]] = self.logp[m - 1][at[seen]] + add[todo[seen]]
            todo, now = todo[~seen], now[~seen] >> BITS
            contexts = self.contexts[m - 1]
            at = np.minimum(np.searchsorted(contexts, now), len(contexts) - 1)
            add[todo] += np.where(contexts[at] == now, self.logb[m - 1][at], 0.0)
        out[todo] = self.unseen + add[todo]
        return out


def discounts(a: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2, 3 and more, from the counts of counts."""
    n = [float((a == j).sum()) for j in (1, 2, 3, 4)]
    if min(n) == 0:
        return np.array([0.5, 0.75, 0.9])  # too few n-grams to estimate them
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]])
    return np.clip(d, 0.05, (0.95, 1.95, 2.95))


def train(docs: DataFrame, across: bool = False) -> dict[str, Model]:
    """In-memory models of a small table (tests hold ``estimates`` against them)."""
    table = ngram_counts(docs, across).where("c > 0").toPandas()
    out = {}
    for lang, part in table.groupby("lang"):
        keys = part["g"].to_numpy(np.int64).view(U64)
        order = np.argsort(keys)
        out[lang] = Model(keys[order], part["c"].to_numpy(np.int64)[order])
    return out


def estimates(counts: DataFrame) -> DataFrame:
    """lang, g, logp of every n-gram in ``counts`` (materialised: lang, g, c;
    c is 0 for n-grams to be scored only)."""
    a, g = F.col("a"), F.col("g")
    grams = {ORDER: counts.select("lang", "g", F.col("c").alias("a"))}
    for n in range(ORDER - 1, 0, -1):  # lower orders count distinct left neighbours
        lower = grams[n + 1].groupBy("lang", g.bitwiseAND((1 << (16 * n)) - 1).alias("g"))
        grams[n] = materialise(lower.agg(F.count_if(a > 0).alias("a")), f"grams-{n}")
    told = reduce(DataFrame.unionByName, (t.select("lang", "a", F.lit(n).alias("n")) for n, t in grams.items()))
    told = told.groupBy("lang", "n").agg(F.count_if(a > 0).alias("seen"), *(F.count_if(a == j).cast("double").alias(f"n{j}")
                                                                          for j in (1, 2, 3, 4)))
    told = materialise(told, "discounts")  # a row for each language and order
    n1, n2, n3, n4 = map(F.col, ("n1", "n2", "n3", "n4"))
    y = F.try_divide(n1, n1 + 2 * n2)
    fitted = (1 - F.try_divide(2 * y * n2, n1), 2 - F.try_divide(3 * y * n3, n2), 3 - F.try_divide(4 * y * n4, n3))
    few = F.least("n1", "n2", "n3", "n4") == 0  # as in ``discounts``
    told = told.select("lang", "n", "seen", *(
        F.when(few, F.lit(usual)).otherwise(F.least(F.greatest(d, F.lit(0.05)), F.lit(most))).alias(f"d{j}")
        for j, (d, usual, most) in enumerate(zip(fitted, (0.5, 0.75, 0.9), (0.95, 1.95, 2.95), strict=True), 1)))
    below = None
    for n in range(1, ORDER + 1):
        d = F.when(a == 0, 0.0).when(a == 1, F.col("d1")).when(a == 2, F.col("d2")).otherwise(F.col("d3"))
        context = Window.partitionBy("lang", F.shiftrightunsigned("g", 16))
        t = grams[n].join(sized(told.where(F.col("n") == n).drop("n")), "lang").withColumn("d", d)
        times = [F.count_if(x).over(context) for x in (a == 1, a == 2, a > 2)]
        taken = F.col("d1") * times[0] + F.col("d2") * times[1] + F.col("d3") * times[2]  # the same in any order
        t = t.withColumns({"total": F.sum("a").over(context), "taken": taken})
        if n == 1:
            t = t.withColumn("lower", 1 / (F.col("seen") + 1))
        else:
            t = t.withColumn("low", g.bitwiseAND((1 << (16 * (n - 1))) - 1)).join(below, ["lang", "low"])
        p = F.when(F.col("total") == 0, F.col("lower")).otherwise(
            F.try_divide(a - F.col("d") + F.col("taken") * F.col("lower"), F.col("total")))
        below = t.select("lang", F.col("g").alias("low"), p.alias("lower"))
    return below.select("lang", F.col("low").alias("g"), F.log("lower").alias("logp"))


def write_model(counts: DataFrame) -> tuple[str, int]:
    """The estimates in parts by hash, sorted: their folder and number."""
    path = scratch_path(counts.sparkSession, "model")
    parts = max(1, -(-counts.count() // PART_ROWS))
    (estimates(counts).withColumn("part", F.pmod(F.pmod("g", F.lit(PRIME)), F.lit(parts)).cast("int"))
     .repartition(parts, "part").sortWithinPartitions("part", "lang", "g").write.partitionBy("part").parquet(path))
    return file_uri(path), parts


class Lookup:
    """Log probabilities of n-grams from the parts of a written model, which are
    kept as packed arrays, or read once for each call where they are too many."""

    def __init__(self, uri: str, parts: int):
        from pyarrow.fs import FileSystem

        self.fs, self.root = FileSystem.from_uri(uri)
        self.parts, self.rows = parts, 0
        self.held: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]] = {}

    def _part(self, k: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        if k in self.held:
            return self.held[k]
        files = pyarrow.dataset.dataset(f"{self.root}/part={k}", filesystem=self.fs, format="parquet")
        rows = files.to_table(columns=["lang", "g", "logp"])
        g, logp = rows["g"].to_numpy(), rows["logp"].to_numpy().astype(np.float32)
        langs = rows["lang"].combine_chunks().dictionary_encode()
        code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        cuts = np.flatnonzero(np.diff(code, prepend=-1, append=-1))  # rows are sorted by language
        part = {names[code[a]]: (g[a:b], logp[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)}
        if self.rows + len(g) <= HELD_ROWS:
            self.held[k] = part
            self.rows += len(g)
        return part

    def logp(self, wanted: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """By language: of each n-gram (``wanted``: distinct ones), in one pass over the parts."""
        keys = {lang: g.view(np.int64) for lang, g in wanted.items()}
        part = {lang: g % PRIME % self.parts for lang, g in keys.items()}
        out = {lang: np.empty(len(g), np.float32) for lang, g in keys.items()}
        for k in sorted({int(x) for p in part.values() for x in np.unique(p)}):
            loaded = self._part(k)
            for lang, g in keys.items():
                mine = np.flatnonzero(part[lang] == k)
                if len(mine):
                    known, logp = loaded[lang]
                    out[lang][mine] = logp[np.searchsorted(known, g[mine])]
        return out


# --- documents ---------------------------------------------------------------

def repeated_words(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Words (all texts in a row) in windows that occur twice in their text."""
    marked = np.zeros(len(ids) + 1, np.int64)
    n = len(ids) - WINDOW + 1
    if n > 0:
        inside = owner[:n] == owner[WINDOW - 1:]
        h = rolling(ids, WINDOW) ^ (owner[:n].astype(U64) * U64(0xD1B54A32D192ED03))
        at = np.flatnonzero(inside)
        order = at[np.argsort(h[at], kind="stable")]
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        np.add.at(marked, order[twice], 1)
        np.add.at(marked, order[twice] + WINDOW, -1)
    return np.cumsum(marked[:-1]) > 0


def _duplicate_lines(text: str) -> int:
    seen, out = set(), 0
    for line in text.split("\n"):
        if line in seen:
            out += bool(WORD.search(line))
        else:
            seen.add(line)
    return out


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _statistics(texts: list[str], found: list[list[str]], coded: np.ndarray) -> list[np.ndarray]:
    n_words = np.fromiter(map(len, found), np.int64, len(found))
    owner = np.repeat(np.arange(len(found)), n_words)
    repeated = np.bincount(owner, repeated_words(coded, owner), len(found)).astype(np.int64)
    chars = [len(t) - sum(map(t.count, SPACES)) for t in texts]
    symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
    lines = [_duplicate_lines(t) if "\n" in t else 0 for t in texts]
    return [n_words, *(np.array(x, np.int64) for x in (chars, symbols, lines)), repeated]


def score(docs: DataFrame, model: tuple[str, int], carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang, the statistics, score (null without words), text_key, and
    the columns in ``carry`` as ``carry_*``."""
    own = {"text"} & set(carry)  # goes to the tasks anyway
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lang(), "text", text_hash().alias("text_key"),
                       *(F.col(c).alias(f"carry_{c}") for c in carry if c not in own))
    extra = [f for f in docs.schema.fields[2:] if f.name != "text" or own]
    names = ["doc_id", "lang", *STATS, "score", *("carry_text" if f.name == "text" else f.name for f in extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(*model)
        for b in batches:
            langs = b.column(1).to_pylist()
            parts = list(chunks(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False), CHARACTERS))
            stats, wanted = [], {}
            for begin, end in parts:
                texts = [t or "" for t in b.column(2)[begin:end].to_pylist()]
                found = [WORD.findall(t) for t in texts]
                number: dict[str, int] = {}
                put = number.setdefault
                coded = np.fromiter((put(w, len(number)) for ws in found for w in ws), np.int64, sum(map(len, found)))
                stats.append(_statistics(texts, found, coded.astype(U64)))
                for lang, _, keys, _, _ in _by_language(langs[begin:end], found):
                    wanted.setdefault(lang, []).append(np.unique(keys))
            merged = {lang: np.unique(np.concatenate(keys)) for lang, keys in wanted.items()}
            logp = lookup.logp(merged)
            scores = np.full(b.num_rows, np.nan)
            for begin, end in parts:
                found = [WORD.findall(t or "") for t in b.column(2)[begin:end].to_pylist()]
                for lang, rows, keys, sizes, starts in _by_language(langs[begin:end], found):
                    each = logp[lang][np.searchsorted(merged[lang], keys)].astype(float)
                    scores[begin + rows] = -np.add.reduceat(each, starts) / sizes
            columns = [np.concatenate([s[i] for s in stats]) if stats else np.empty(0, np.int64) for i in range(len(STATS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *map(pa.array, columns), pa.array(scores, from_pandas=True),
                 *(b.column(f.name) for f in extra)], names)

    schema = "doc_id long, lang string, " + ", ".join(f"{s} long" for s in STATS) + ", score double"
    kinds = (f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names[-len(extra):], extra, strict=True))
    return docs.mapInArrow(run, ", ".join([schema, *kinds]))


def _by_language(langs: list[str], found: list[list[str]]) -> Iterator[tuple]:
    """lang, rows, and the units of their texts, a language at a time."""
    for lang in sorted(set(langs)):
        rows = np.array([i for i, x in enumerate(langs) if x == lang and found[i]], np.int64)
        if len(rows):
            yield lang, rows, *_units([_flat(found[i]) for i in rows])


def fit_bounds(counts: list[tuple[str, int, int, int, int]], band: float) -> dict[str, tuple[float, float]]:
    """Lower and upper bound of each language, in units of the band's middle
    half: those that misjudge the fewest labelled texts.  ``counts``: language,
    label, steps below q1, steps above q3, texts.  The texts of all languages
    together count as ``PRIOR`` texts of each, so that few labels do not decide
    alone; of equally good bounds, the middle one is taken."""
    every = np.zeros((2, 2, STEPS + 1))  # side, label, steps
    own: dict[str, np.ndarray] = {}
    for lang, label, below, above, n in counts:
        mine = own.setdefault(lang, np.zeros_like(every))
        for side, step in enumerate((below, above)):
            mine[side, label, step] += n
            every[side, label, step] += n
    every *= min(1.0, PRIOR / max(every[0].sum(), 1.0))

    def best(bad: np.ndarray, good: np.ndarray) -> float:
        if not bad.sum():
            return band
        cost = np.cumsum(bad) + good.sum() - np.cumsum(good)  # bad texts inside, good ones outside
        ties = np.flatnonzero(cost[1:] <= cost[1:].min() + 1e-9) + 1
        return float(ties[len(ties) // 2]) / PER_UNIT

    out = {lang: tuple(best(*(h[side] + every[side])) for side in (0, 1)) for lang, h in own.items()}
    out[""] = out.get("", tuple(best(*every[side]) for side in (0, 1)))
    return out


def judge(docs: DataFrame, carry: tuple[str, ...] = (), band: float = BAND,
          labels: DataFrame | None = None) -> DataFrame:
    """The statistics, score, base_failed and kept of every document.
    ``labels``: doc_id, quality (1 good, 0 bad), of some documents."""
    bounded_batches(docs.sparkSession, COUNT_BYTES)
    counts = materialise(ngram_counts(weighted(docs, labels), across=True), "ngrams")
    bounded_batches(docs.sparkSession)  # a model of many parts is read again for each batch
    scored = materialise(score(docs, write_model(counts), carry), "quality")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    scored = scored.withColumn("base_failed", base)
    quarter = [F.percentile_approx("score", q, 10_000).alias(n) for q, n in ((0.25, "q1"), (0.75, "q3"))]
    once = scored.where("not base_failed").groupBy("lang", "text_key").agg(F.max("score").alias("score"))
    bands = materialise(once.groupBy("lang").agg(*quarter), "bands")  # a row for each language
    unit = F.greatest(F.col("q3") - F.col("q1"), F.lit(FLOOR)) * (1 + SHORT / F.sqrt(F.greatest("n_words", F.lit(1))))
    bands = bands.withColumns({"lower": F.lit(band), "upper": F.lit(band)})
    if labels is not None:
        steps = [F.ceil(F.least(F.greatest(x / unit * PER_UNIT, F.lit(0.0)), F.lit(float(STEPS)))).cast("int")
                 for x in (F.col("q1") - F.col("score"), F.col("score") - F.col("q3"))]
        told = _labelled(scored.where("not base_failed"), labels).where("quality is not null")
        told = (told.groupBy("lang", "text_key").agg(F.min("quality").alias("quality"), F.max("score").alias("score"),
                                                     F.max("n_words").alias("n_words")).join(sized(bands), "lang"))
        counts = told.groupBy("lang", "quality", steps[0].alias("below"), steps[1].alias("above")).count().collect()
        bounds = fit_bounds([tuple(r) for r in counts], band)  # at most 2 * STEPS ** 2 rows for each language
        usual = bounds[""]
        # as an Arrow table: a list would go through plain Python workers, which then stay beside the Arrow ones
        bounds = docs.sparkSession.createDataFrame(pa.table(
            {"lang": pa.array(list(bounds), pa.string()), "lower": pa.array([v[0] for v in bounds.values()], pa.float64()),
             "upper": pa.array([v[1] for v in bounds.values()], pa.float64())}))
        bands = bands.drop("lower", "upper").join(F.broadcast(bounds), "lang", "left").fillna(
            {"lower": usual[0], "upper": usual[1]})
        bands = materialise(bands, "bounds")
    inside = F.col("score").between(F.col("q1") - F.col("lower") * unit, F.col("q3") + F.col("upper") * unit)
    return (scored.join(sized(bands), "lang", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
            .drop("q1", "q3", "lower", "upper", "text_key"))
