"""Token ids of a public vocabulary, a batch of texts at a time.

The vocabulary's pre-tokeniser never joins across white space, so a text's
ids are the concatenated ids of its white-space separated chunks.  Each
distinct chunk of a batch is encoded once, by byte-pair merging with the
vocabulary's own merges (same ids as the tokenizer gives, see tests), and the
ids are put together by array indexing.  Texts with characters outside plain
ASCII and Latin letters take the tokenizer's own path, because normalisation
could cross chunk borders.  Special-token strings inside a text are ordinary
text.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The end-of-document id, and the characters whose
# normalisation is just lower case (no combining marks, no unusual spaces).
END_ID = 2
PLAIN = "^[\t-\r\x20-~À-ÖØ-öø-įı-ňŊ-ž]*$"
# Fixed value: the vocabulary's pre-tokeniser pattern, for plain characters.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-ž]+|[0-9]|[^\\sa-zß-ž0-9]+")
WORD_END = "</w>"
# Two control characters that plain texts do not hold: end of a piece, end of a chunk.
PIECE, CHUNK = "\x01", "\x02"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _merger(path: str):
    """Byte-pair encoder over the vocabulary's merges; the ids by rank; the
    rank of a lone CHUNK character."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in shown]
    char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    byte = {c: b for b, c in char.items()}

    def raw(token: str) -> bytes:
        body = token.removesuffix(WORD_END)
        return bytes(byte[c] for c in body) + (PIECE.encode() if body != token else b"")

    names = [*(char[b] for b in range(256)), *(char[b] + WORD_END for b in range(256) if b != ord(PIECE)),
             *(a + b for a, b in model["merges"])]
    ranks = {bytes([b]): b for b in range(256)}
    for name in names[256:]:
        ranks[raw(name)] = len(ranks)
    if len(ranks) != len(names) or max(vocab.values()) > 0xFFFF:
        raise ValueError("not a vocabulary with unambiguous merges and 16-bit ids")
    core = tiktoken.Encoding("merges", pat_str=f"[^{PIECE}]+{PIECE}", mergeable_ranks=ranks, special_tokens={})
    return core, np.array([vocab[n] for n in names], "<u2"), ranks[(CHUNK + PIECE).encode()]


class Encoder:
    """Texts -> little-endian 16-bit ids, without an end id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.core, self.ids, self.chunk_rank = _merger(path)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the chunks in a row, and where each chunk's ids begin and end."""
        row = pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks)
        pieces = PIECES.findall(pc.binary_join(row, f" {CHUNK} ")[0].as_py() + f" {CHUNK}")
        ranks = self.core.encode_to_numpy(PIECE.join(pieces) + PIECE, disallowed_special=())
        ends = np.flatnonzero(ranks == self.chunk_rank).astype(np.int32)
        begins = np.concatenate((np.zeros(1, np.int32), ends[:-1] + 1))
        return self.ids[ranks], begins, ends

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """One array of ids for each text; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        plain = pc.match_substring_regex(texts, PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts.filter(pa.array(plain))))
        coded = pc.list_flatten(words).dictionary_encode()
        out: list = [None] * len(texts)
        if len(coded):
            ids, begins, ends = self._chunks(coded.dictionary)
            codes = coded.indices.to_numpy()
            sizes = (ends - begins)[codes]
            upto = np.zeros(len(codes) + 1, np.int32)
            np.cumsum(sizes, out=upto[1:])
            at = np.repeat(begins[codes] - upto[:-1], sizes)
            at += np.arange(len(at), dtype=np.int32)
            flat = ids[at]
            per_text = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            borders = upto[np.concatenate(([0], np.cumsum(per_text)))]
        else:
            flat, borders = np.empty(0, "<u2"), np.zeros(int(plain.sum()) + 1, np.int64)
        for k, i in enumerate(np.flatnonzero(plain)):
            out[i] = flat[borders[k]:borders[k + 1]]
        for i in np.flatnonzero(~plain):
            e = self.tok.encode(texts[int(i)].as_py(), add_special_tokens=False)
            out[i] = np.asarray(e.ids, "<u2")
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
