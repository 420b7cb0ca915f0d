"""Texts as arrays: words found and hashed by whole-batch array operations, and growing tables of per-word results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Byte table that lower-cases A-Z only.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: ASCII white space, ``[\x20\x09-\x0D]``.
SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
# The other white space of Unicode, as UTF-8.
_WIDE_SPACE = [bytes(chr(c), "utf-8") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with at most ``limit`` bytes of text each, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and where each text begins (and the last ends). Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


class Words:
    """Words of consecutive texts: their bytes, where they lie, how many each text has, and a 64-bit hash of each.

    The hash is a polynomial over fixed random codes of the bytes, mixed with the length: two different words share
    it with probability of about 2^-64."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray):
        self.raw, self.starts, self.lengths = raw, starts, ends - starts
        self.counts = np.diff(np.searchsorted(starts, offsets))
        self.hashes = np.zeros(len(starts), np.uint64)
        if len(starts):
            longest = int(self.lengths.max())
            powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, _BASE, np.uint64)]))
            # bytes between words belong to the word before them and count nothing
            spans = np.diff(np.append(starts, len(raw)))
            place = np.arange(starts[0], len(raw), dtype=np.int32) - np.repeat(starts.astype(np.int32), spans)
            terms = _BYTE_CODES[raw[starts[0]:]]
            terms *= powers[np.minimum(place, longest)]
            terms[place >= np.repeat(self.lengths.astype(np.int32), spans)] = 0
            self.hashes = mix(np.add.reduceat(terms, starts - starts[0]) + self.lengths.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.starts)

    def take(self, which: np.ndarray) -> list[bytes]:
        """The bytes of some words."""
        raw = self.raw.tobytes()
        ends = self.starts + self.lengths
        return [raw[s:e] for s, e in zip(self.starts[which].tolist(), ends[which].tolist())]


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """Maximal runs without ASCII white space; with ``lower``, A-Z is lower-cased first."""
    raw, offsets = text_bytes(texts)
    raw = LOWER[raw] if lower else raw
    solid = ~SPACE[raw]
    begins, stops = solid.copy(), np.ones(len(raw), bool)
    begins[1:] &= ~solid[:-1]
    stops[:-1] = ~solid[1:]
    borders = offsets[(offsets > 0) & (offsets < len(raw))]
    begins[borders] = solid[borders]
    stops[borders - 1] = True
    return Words(raw, np.flatnonzero(begins), np.flatnonzero(stops & solid) + 1, offsets)


def split_pieces(texts: pa.Array) -> Words:
    """Runs of Unicode white space, each with the run of other characters that follows it; the pieces make up the texts."""
    raw, offsets = text_bytes(texts)
    white = SPACE[raw]
    if len(raw) and raw.max() >= 0x80:
        leads = {code[0] for code in _WIDE_SPACE}
        for lead in leads:
            at = np.flatnonzero(raw == lead)
            for code in _WIDE_SPACE:
                if code[0] == lead and len(at):
                    fits = at[at + len(code) <= len(raw)]
                    for i, byte in enumerate(code[1:], 1):
                        fits = fits[raw[fits + i] == byte]
                    for i in range(len(code)):
                        white[fits + i] = True
    begins = white.copy()
    begins[1:] &= ~white[:-1]
    borders = offsets[offsets < len(raw)]
    begins[borders] = True
    starts = np.flatnonzero(begins)
    return Words(raw, starts, np.append(starts[1:], len(raw)) if len(starts) else starts, offsets)


class HashIndex:
    """Rows by 64-bit hash: open addressing in two arrays, searched and filled for whole batches at once."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where it has none. Hashes are not 0."""
        out = np.full(len(hashes), -1, np.int64)
        active = np.arange(len(hashes))
        slot = (hashes & self.mask).astype(np.int64)
        while len(active):
            keys = self.keys[slot]
            hit = keys == hashes[active]
            out[active[hit]] = self.rows[slot[hit]]
            on = ~hit & (keys != 0)
            active, slot = active[on], (slot[on] + 1) & int(self.mask)
        return out

    def add(self, hashes: np.ndarray, first: int) -> None:
        """Gives distinct new hashes the rows ``first``, ``first`` + 1 and so on."""
        self._add(hashes, np.arange(first, first + len(hashes), dtype=np.int32))

    def add_constant(self, hashes: np.ndarray, row: int) -> None:
        """Gives distinct new hashes one row."""
        self._add(hashes, np.full(len(hashes), row, np.int32))

    def _add(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        slot = (hashes & self.mask).astype(np.int64)
        while len(hashes):
            free = np.flatnonzero(self.keys[slot] == 0)
            self.keys[slot[free]] = hashes[free]
            won = free[self.keys[slot[free]] == hashes[free]]
            self.rows[slot[won]] = rows[won]
            rest = np.ones(len(hashes), bool)
            rest[won] = False
            hashes, rows, slot = hashes[rest], rows[rest], (slot[rest] + 1) & int(self.mask)


class Lexicon:
    """Arrays of any length per word, computed once for each word a worker meets.

    ``compute(words)`` gets the bytes of words and gives (values, lengths): the results of all words, one after another.
    The table is emptied when it would pass ``capacity`` words, so its memory is bounded; results do not change.
    """

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], capacity: int = 500_000):
        self.compute, self.capacity = compute, capacity
        self._empty()

    def _empty(self) -> None:
        self.index = HashIndex(max(4, (2 * self.capacity - 1).bit_length()))
        self.count = self.used = 0
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.values: np.ndarray | None = None

    def rows(self, words: Words) -> np.ndarray:
        """The table's row of each word."""
        hashes = np.where(words.hashes == 0, np.uint64(1), words.hashes)
        found = self.index.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            fresh, first = np.unique(hashes[missing], return_index=True)
            if self.count + len(fresh) > self.capacity:
                if self.count:
                    self._empty()
                    return self.rows(words)
                self.index = HashIndex((2 * len(fresh)).bit_length())
            values, lengths = self.compute(words.take(missing[first]))
            self.index.add(fresh, self.count)
            self.starts = _put(self.starts, self.count, self.used + np.cumsum(lengths) - lengths)
            self.lengths = _put(self.lengths, self.count, lengths)
            self.values = _put(np.zeros(0, values.dtype) if self.values is None else self.values, self.used, values)
            self.count += len(fresh)
            self.used += len(values)
            found[missing] = self.index.find(hashes[missing])
        return found

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows, one after another, and how many each row has."""
        lengths = self.lengths[rows].astype(np.int64)
        if self.values is None or not len(rows):
            return np.zeros(0, np.int64), lengths
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - lengths), lengths)
        return self.values[at], lengths

    def single(self, rows: np.ndarray) -> np.ndarray:
        """The value of each row, where every word has one."""
        return self.values[rows] if self.values is not None and len(rows) else np.zeros(0)


def _put(array: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` written from ``at`` on, grown by doubling."""
    if at + len(more) > len(array):
        grown = np.zeros(max(at + len(more), 2 * len(array), 1024), array.dtype)
        grown[:at] = array[:at]
        array = grown
    array[at:at + len(more)] = more
    return array


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` with the given lengths (0 for empty runs)."""
    total = np.concatenate([np.zeros(1, np.int64 if values.dtype.kind == "i" else values.dtype), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
