"""Word-wise use of a public tokenizer: pieces between which no token can reach are encoded once."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa

from .words import SPACE, Lexicon, Words, split_pieces, sums, text_bytes


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def version_digest(path: str) -> str:
    """Identifies the tokenizer by its file's content."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceEncoder:
    """Ids of texts by a tokenizers file, one encoding per distinct piece a worker meets.

    A piece is a run of white space and the run of other characters after it: no pre-token of the public tokenizers
    reaches from one piece into the next, so the ids of a text are those of its pieces."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.lexicon = Lexicon(self._encode)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode("utf-8") for p in pieces]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum())), lengths

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        words = split_pieces(texts)
        ids, lengths = self.lexicon.gather(self.lexicon.rows(words))
        return ids, sums(lengths, words.counts)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        words = split_pieces(texts)
        rows = self.lexicon.rows(words)
        return sums(self.lexicon.lengths[rows].astype(np.int64), words.counts)


def neighbours(labels: list[bytes]) -> np.ndarray:
    """Which bytes are neighbours inside some token, as a table of 256 x 256: where two are not, no token can hold both."""
    out = np.zeros((256, 256), bool)
    for label in labels:
        for x, y in zip(label, label[1:]):
            out[x, y] = True
    return out


def apart_in_words(labels: list[bytes]) -> np.ndarray:
    """Pairs of ASCII characters between which a text of byte-level tokens may be cut: no token holds both, neither is white space, and neither
    is an apostrophe, which begins contractions."""
    blunt = np.array([c >= 127 or c <= 32 or c == 39 for c in range(256)])
    return ~neighbours(labels) & ~blunt[:, None] & ~blunt


def cut_at(raw: np.ndarray, begins: np.ndarray, offsets: np.ndarray) -> Words:
    """The pieces that begin at the marked places; together they are the texts."""
    begins[offsets[offsets < len(raw)]] = True
    starts = np.flatnonzero(begins)
    return Words(raw, starts, np.append(starts[1:], len(raw)) if len(starts) else starts, offsets)


def split_finely(texts: pa.Array, apart: np.ndarray) -> Words:
    """The pieces of :func:`split_pieces`, cut further between the characters that ``apart`` marks: fewer distinct ones, as words and the marks
    that follow them come apart."""
    words = split_pieces(texts)
    raw, offsets = text_bytes(texts)
    begins = np.zeros(len(raw), bool)
    begins[1:] = apart[raw[:-1], raw[1:]]
    begins[words.starts] = True
    return cut_at(raw, begins, offsets)
