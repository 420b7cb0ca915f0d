"""Spelling variants against plain counting and comparison of all pairs."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from quantloom.llm import spelling
from quantloom.llm.spelling import spelling_variants

from .cases import awkward_rows, empty, same, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def counted(rows, least=5, every=97):
    n = collections.Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return n


def brute(rows, times=3, every=97):
    n = {w: c for w, c in counted(rows, every=every).items() if c >= times}
    form, close = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        close[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], close[w], n.get(form[w])))
    return out


def misspelt(seed, words, n, alphabet="abcdeé"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 9))) for _ in range(words)]
    def one():
        w = rng.choice(base[: 1 + int(len(base) * rng.random() ** 2)])
        for _ in range(rng.choice([0, 0, 1, 2])):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:]])
        return w.upper() if rng.random() < 0.1 else w
    return [(i, rng.choice([" ", ", ", "×1", "ß9"]).join(one() for _ in range(40))) for i in range(n)]


def test_variants_equal_comparison_of_all_pairs(spark):
    rows = misspelt(1, 60, 60) + [(i + 1000, t) for i, t in awkward_rows() if i is not None] + [(None, "stone stones stonez stonee stone stone")]
    same(spelling_variants(table(spark, rows)), brute(rows))
    # every third word loses a letter
    same(spelling_variants(table(spark, rows), every=3), brute(rows, every=3))


def test_parts_of_the_trie_change_nothing(spark, monkeypatch):
    rows = misspelt(2, 80, 60)
    monkeypatch.setattr(spelling, "PART_WORDS", 20)
    monkeypatch.setattr(spelling, "PART_QUERIES", 30)
    monkeypatch.setattr(spelling, "_BLOCK", 64)
    same(spelling_variants(table(spark, rows)), brute(rows))


def test_long_words_anagrams_and_chains(spark):
    long = "".join(random.Random(5).choice("abcdefgh") for _ in range(400))
    words = collections.Counter({
        long: 12, long[:-1]: 5, long[:100] + "z" + long[101:]: 4, "a" * 70: 20, "a" * 69: 9, "a" * 71: 4, "a" * 38: 3, "abcdef": 3,
        "bacdef": 7, "abcdfe": 9, "xbcdef": 6, "xycdef": 12, "xyzdef": 24, "xyzwef": 48, "fedcba": 5, "abcde": 3, "äbcdef": 6})
    text = " ".join(w for w, n in words.items() for _ in range(n))
    same(spelling_variants(table(spark, [(1, text)]), every=10**9 + 7), brute([(1, text)], every=10**9 + 7))


def test_empty(spark):
    assert spelling_variants(empty(spark)).count() == 0
    assert spelling_variants(table(spark, [(1, None), (2, ""), (3, "word 12 ab")])).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(empty(spark), least=3)


def test_joined_crc():
    rng = random.Random(4)
    parts = [(bytes(rng.randrange(256) for _ in range(rng.randrange(12))), bytes(rng.randrange(256) for _ in range(rng.choice([0, 3, 64, 65, 500])))) for _ in range(50)]
    found = spelling.joined_crc(*(np.array(x) for x in ([zlib.crc32(a) for a, _ in parts], [zlib.crc32(b) for _, b in parts], [len(b) for _, b in parts])))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in parts]
