"""Packing by power-of-two decomposition: every sequence is one piece of one document."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lean, small_batches, text_of
from .tokenizers import PieceEncoder, load
from .words import Lexicon, Words, slices, split_words, sums, text_bytes


#: Kinds of ASCII characters that never share a pre-word: letters, and marks but apostrophes, which begin contractions.
_KIND = np.array([1 if chr(c).isalpha() else 2 if 32 < c < 127 and not chr(c).isdigit() and c != 39 else 0 for c in range(128)] + [0] * 128, np.uint8)


def split_lower(texts: pa.Array) -> Words:
    """The lower-cased words of the texts, and marks cut off from the letters beside them: fewer distinct ones."""
    words = split_words(texts)
    kind = _KIND[words.raw]
    begins, ends = np.zeros((2, len(kind) + 1), bool)
    begins[1:-1] = ends[1:-1] = kind[1:] * kind[:-1] == 2
    begins[words.starts] = True
    ends[words.starts + words.lengths] = True
    _, offsets = text_bytes(texts)
    return Words(words.raw, np.flatnonzero(begins), np.flatnonzero(ends), offsets)


class LowerWordEncoder:
    """Ids of texts by a tokenizer that lower-cases and drops white space, one encoding per distinct word.

    Words are split at ASCII white space and between letters and marks, and A-Z is lower-cased first, which the tokenizer would do anyway. Words of
    letters alone are encoded many at a time; each ends where a token carries the end-of-word mark. Texts
    that may hold a special string, whose case counts, are left to the plain piece encoder.
    """

    def __init__(self, path: str):
        self.path, self.plain = path, None
        self.tokenizer = load(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        self.lexicon = Lexicon(self._encode)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode("utf-8") for w in words]
        encode = self.tokenizer.encode_batch_fast
        joint = np.array([i for i, t in enumerate(texts) if t.isalpha()], np.int64)
        lengths = np.zeros(len(words), np.int64)
        parts, owners = [], []
        for at in range(0, len(joint), 2000):
            group = joint[at:at + 2000]
            ids = np.array(encode([" ".join(texts[i] for i in group)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group):
                lengths[group] = np.diff(ends, prepend=0)
                parts.append(ids)
                owners.append(group)
        rest = np.setdiff1d(np.arange(len(words)), np.concatenate([*owners, joint[:0]]), assume_unique=True)
        for i, e in zip(rest.tolist(), encode([texts[i] for i in rest], add_special_tokens=False)):
            lengths[i] = len(e.ids)
            parts.append(np.array(e.ids, np.int32))
        # the parts hold the words of the groups, then the others; each word's ids go to their place in the order of the words
        order = np.concatenate([*owners, rest])
        sizes = lengths[order]
        place = (np.cumsum(lengths) - lengths)[order] - (np.cumsum(sizes) - sizes)
        out = np.empty(int(lengths.sum()), np.int32)
        out[np.repeat(place, sizes) + np.arange(len(out))] = np.concatenate([*parts, out[:0]])
        return out, lengths

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            self.plain = self.plain or PieceEncoder(self.path)
            return self.plain.ids(texts)
        words = split_lower(texts)
        ids, lengths = self.lexicon.gather(self.lexicon.rows(words))
        return ids, sums(lengths, words.counts)


def binary_pieces(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: as many of ``longest`` as fit, then the binary digits of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(totals: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all pieces of documents of ``totals`` ids: the document's place, where the piece starts in it, and its length, as :func:`binary_pieces` cuts."""
    bits = longest.bit_length() - 1
    # one column for the pieces of the greatest length, one for each binary digit of the rest, the highest first
    digits = np.column_stack([totals // longest, *((totals >> b) & 1 for b in range(bits - 1, -1, -1))])
    sizes = np.tile(np.array([longest, *(1 << b for b in range(bits - 1, -1, -1))], np.int64), len(totals))
    length = np.repeat(sizes, digits.ravel())
    document = np.repeat(np.arange(len(totals)), digits.sum(axis=1))
    before = np.cumsum(totals) - totals
    return document, np.cumsum(length) - length - before[document], length


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("ids_crc32", pa.int64()), ("input_ids", pa.list_(pa.int32()))])
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, input_ids array<int>"


def _pieces(path: str, longest: int, end_id: int):
    @lean
    def run(batches):
        encoder = LowerWordEncoder(path)
        for batch in batches:
            for part in slices(batch):
                ids, counts = encoder.ids(part.column("text"))
                whole = np.insert(ids.astype("<i4"), np.cumsum(counts), end_id)
                totals = counts.astype(np.int64) + 1
                document, start, length = cut(totals, longest)
                ends = np.cumsum(length)
                raw = memoryview(whole).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), length.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(whole, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(document)), pa.array(start), pa.array(length), pa.array(totals[document]),
                     pa.array(crc, pa.int64()), lists], schema=_PIECE)

    return run


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, input_ids, bucket, sequence_id, offset.

    A document is its ids and ``end_id``. It is cut into pieces whose lengths are powers of two, ``longest``
    (itself a power of two) at most; each piece is a sequence of its own in the bucket of its length. So no sequence
    crosses documents, none is padded, and batches of one bucket have one shape. Order inside a document is by
    ``start``. Cutting needs one pass and no shuffle, whatever the number of documents of one source; ``write_buckets`` stores it.

    ``sequence_id`` is unique in one result: the task's number and the row's number in it, which a repeated task gives
    again. Null and empty texts are the end id alone. Repeated rows give their pieces again, in sequences of their own; null
    ids stay null. An empty table gives no rows; other columns are ignored.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = texts.mapInArrow(_pieces(tokenizer_path, longest, end_id), PIECE_SCHEMA)
    return pieces.withColumns({"bucket": F.col("length"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length; a long bucket is split over many files by its rows."""
    packed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
