"""Sets of word shingles as ascending 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import mix, split_words

# odd multipliers that make the hash of a shingle depend on the order of its words
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


class Shingler:
    """Texts to sets of ``width``-word shingles; one hash per distinct shingle, ascending.

    Words are maximal runs without ASCII white space, with A-Z lower-cased. A text with fewer words than
    ``width`` has its whole sequence as its one shingle; a text without words has none.
    """

    def __init__(self, width: int):
        self.width = width

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All sets, one after another, and their sizes."""
        words = split_words(texts)
        counts, hashes = words.counts, words.hashes
        if not len(hashes):
            return np.zeros(0, np.uint64), counts
        starts = np.cumsum(counts) - counts
        widths = np.minimum(counts, self.width)
        sizes = np.where(counts > 0, counts - widths + 1, 0)
        # a shingle starts at every word but the last width - 1 of its text
        at = np.flatnonzero(np.arange(len(hashes)) - np.repeat(starts, counts) <= np.repeat(counts - widths, counts))
        reach = np.repeat(widths, sizes)
        total = reach.astype(np.uint64)
        for i in range(self.width):
            factor = _FACTORS[i % 64]
            if (reach <= i).any():
                some = reach > i
                total[some] = mix(total[some] + hashes[at[some] + i] * factor)
            else:
                total = mix(total + hashes[at + i] * factor)
        ends = np.cumsum(sizes)
        for start, end in zip((ends - sizes).tolist(), ends.tolist()):
            total[start:end].sort()
        fresh = np.ones(len(total), bool)
        fresh[1:] = total[1:] != total[:-1]
        fresh[(ends - sizes)[sizes > 0]] = True
        kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(fresh)])
        return total[fresh], kept[ends] - kept[ends - sizes]

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        values, sizes = self.flat(texts)
        return np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else []


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
