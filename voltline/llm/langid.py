"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability sums over all its segmentations into pieces (forward
algorithm), a text's is the product over its words; the language with the
highest posterior wins.  Piece probabilities are fitted by expectation
maximisation over segmentations (forward-backward) on word counts that Spark
aggregates from a bounded sample of the labelled rows: about ``FIT_ROWS`` of
each language, chosen by hash.  Scoring covers every word of every text.

Words are runs of letters, lower-cased, with the vocabulary's word mark; runs
over ``LONGEST`` letters are cut into words of that length.  A character
without a piece counts as one unknown piece.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is everything when nothing could be learned; ties go to the first
language by name; rows with a null doc_id are neither held out nor learned
from; repeated rows are predicted as often as they occur; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.llm.common import U64, bounded_batches, materialise, mix, sized

LETTERS = regex.compile(r"\p{L}+")  # letters of any script; neither digits nor numerals such as ² or Ⅷ
MARK = "▁"
LONGEST = 40
FIT_ROWS = 6_000  # labelled rows of each language that the model is fitted on, about
ROUNDS = 3
SMOOTH = 0.02  # added to every piece's expected count
UNKNOWN = 1e-7  # probability of a character without a piece
SCALE = 300.0  # keeps products in range: each character counts by this factor
HASH = U64(0x9E3779B97F4A7C15)


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def words_of(text: str | None) -> list[str]:
    """Words of a text, marked and cut."""
    out = []
    for w in LETTERS.findall(text.lower()) if text else ():
        out += [MARK + w] if len(w) <= LONGEST else [
            (MARK if k == 0 else "") + w[k:k + LONGEST] for k in range(0, len(w), LONGEST)]
    return out


class Vocabulary:
    """Pieces by hash, sorted; number 0 is the unknown piece."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = sorted({p for i in range(sp.get_piece_size())
                         if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
                         and LETTERS.fullmatch((p := sp.id_to_piece(i)).removeprefix(MARK) or "a")
                         and p == p.lower()})
        h = np.array([self._hash(p) for p in pieces], U64)
        order = np.argsort(h)
        self.hashes = h[order]
        self.pieces = [pieces[i] for i in order]
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces share a hash")
        self.longest = max(map(len, pieces))
        self.size = len(pieces) + 1

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(HASH) + ord(c) + 1) & (2**64 - 1)
        return h

    def lattice(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For words of one length: their places, and the piece numbers by
        (end, length, word); -1: no such piece, 0: unknown character."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            codes = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"),
                                  "<u4").reshape(len(at), n).T.astype(U64)
            found = np.full((n, min(self.longest, n), len(at)), -1, np.int32)
            for begin in range(n):
                h = np.zeros(len(at), U64)
                for length in range(1, min(self.longest, n - begin) + 1):
                    h = h * HASH + codes[begin + length - 1] + U64(1)
                    k = np.minimum(np.searchsorted(self.hashes, h), self.size - 2)
                    found[begin + length - 1, length - 1] = np.where(self.hashes[k] == h, k + 1, -1)
            single = found[:, 0]
            single[single < 0] = 0
            yield at, found


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def forward(found: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha by (end, word, language): scaled sums over segmentations.
    ``p``: piece x language, a last row of zeros for piece -1."""
    n, longest, w = found.shape
    alpha = np.zeros((n + 1, w, p.shape[1]))
    alpha[0] = 1
    for end in range(n):
        for length in range(1, min(longest, end + 1) + 1):
            ids = found[end, length - 1]
            if (ids >= 0).any():
                alpha[end + 1] += alpha[end + 1 - length] * p[ids] * SCALE**length
    return alpha


def log_likelihoods(words: list[str], vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """word x language"""
    out = np.empty((len(words), p.shape[1]))
    for at, found in vocab.lattice(words):
        out[at] = np.log(forward(found, p)[-1]) - len(found) * np.log(SCALE)
    return out


def expected_counts(words: list[str], counts: np.ndarray, vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Expected number of each piece under one language's probabilities."""
    out = np.zeros(vocab.size)
    for at, found in vocab.lattice(words):
        n, longest, w = found.shape
        alpha = forward(found, p[:, None])[..., 0]
        beta = np.zeros((n + 1, w))
        beta[n] = counts[at] / alpha[n]
        for end in range(n - 1, -1, -1):
            for length in range(1, min(longest, end + 1) + 1):
                ids = found[end, length - 1]
                use = ids >= 0
                if use.any():
                    share = p[ids] * SCALE**length * beta[end + 1]
                    beta[end + 1 - length] += share
                    out += np.bincount(ids[use], (alpha[end + 1 - length] * share)[use], vocab.size)
    return out


def _padded(p: np.ndarray) -> np.ndarray:
    return np.concatenate([p, np.zeros((1, *p.shape[1:]))])


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_counts(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """lang, word, c over the sample of labelled rows."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~is_held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    share = known.groupBy("lang").agg((F.lit(float(fit_rows)) / F.count("*")).alias("share")).withColumnRenamed(
        "lang", "s_lang")
    share = sized(materialise(share, "shares"))  # a row for each language: texts stay where they are
    sample = known.join(share, F.col("lang") == F.col("s_lang")).where(
        F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < F.col("share") * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text))
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                     pa.array(list(c.values()), pa.int64())], ["lang", "word", "c"])

    return (sample.select("lang", "text").mapInArrow(run, "lang string, word string, c long")
            .groupBy("lang", "word").agg(F.sum("c").alias("c")))


def fit(docs: DataFrame, path: str, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages by name, and piece probabilities (piece x language)."""
    vocab = vocabulary(path)
    spark = docs.sparkSession
    counts = materialise(word_counts(docs, fit_rows), "word-counts")
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    p = np.full((vocab.size, len(langs)), 1.0 / vocab.size)
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast((langs, _padded(p)))

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            langs, p = shared.value
            v = vocabulary(path)
            total = np.zeros((v.size, len(langs)))
            for b in batches:
                for lang, part in b.groupby("lang"):
                    j = langs.index(lang)
                    total[:, j] += expected_counts(part["word"].tolist(), part["c"].to_numpy(float), v, p[:, j])
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "c": total[piece, lang]})

        # at most vocabulary x languages rows come back
        got = counts.mapInPandas(expect, "piece int, lang int, c double").groupBy("piece", "lang").agg(
            F.sum("c").alias("c")).toPandas()
        c = np.full(p.shape, SMOOTH)
        np.add.at(c, (got["piece"].to_numpy(), got["lang"].to_numpy()), got["c"].to_numpy())
        c[0] = 0
        p = c / c.sum(axis=0) * (1 - UNKNOWN)
        p[0] = UNKNOWN
    return langs, p


def predict(docs: DataFrame, path: str | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior, uniform prior)."""
    path = path or vocabulary_path()
    bounded_batches(docs.sparkSession)
    langs, p = fit(docs, path, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast((langs, _padded(p)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, p = shared.value
        vocab = vocabulary(path)
        for b in batches:
            found = [words_of(t) for t in b.column(2).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            number: dict[str, int] = {}
            put = number.setdefault
            coded = np.fromiter((put(w, len(number)) for ws in found for w in ws), np.int64, int(sizes.sum()))
            pred, score = ["und"] * len(found), np.zeros(len(found))
            if langs and len(coded):
                by_word = log_likelihoods(list(number), vocab, p)
                some = np.flatnonzero(sizes)
                sums = np.add.reduceat(by_word[coded], (np.cumsum(sizes) - sizes)[some])
                best = np.argmax(sums, axis=1)
                top = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i, j, s in zip(some, best, top, strict=True):
                    pred[i], score[i] = langs[j], s
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(pred), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"),
                        "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))
