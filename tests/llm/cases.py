"""Awkward tables and brute-force answers."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

WORDS = "the of and river stone light window garden paper music silver mountain letter winter morning bridge".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "ly"]) for _ in range(n))


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows and copies."""
    base = prose(1, 60)
    near = base.replace(" ", "  ", 1).rsplit(" ", 1)[0] + " changed"
    return [
        (1, base), (2, base.replace(" ", "\n")), (3, base + "  "), (4, base + "  "), (5, near), (6, near), (7, None), (8, ""), (9, " \t\n"),
        (10, "Word"), (11, "two words"), (12, "TWO words"), (13, prose(2, 30_000)), (14, "é漢字 ß   x y <|endoftext|> z"), (15, prose(3, 45)),
        (15, prose(3, 45)), (None, prose(4, 50)), (16, "12 34 !!"), (17, "a" * 3000), (-5, prose(5, 80)), (18, prose(5, 80)),
    ]


def table(spark, rows, clash=True):
    """(doc_id, text) with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clash:
        for name in ("node", "bucket", "n", "size", "hash", "norm", "score", "document", "ids", "component", "target", "content", "segment"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return table(spark, [])


def exact(rows):
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((i, len(t or "")))
    out = []
    for i, t in rows:
        members = groups[norm(t)]
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] if m[0] is not None else 0))[0]
        out.append((i, keep, len(members), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


def words_of(text):
    raw = (text or "").encode()
    return bytes(c + 32 if 65 <= c <= 90 else c for c in raw).split()


def shingle_set(text, width):
    w = words_of(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near(rows, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    links = []
    for x in range(len(sets)):
        for y in range(x):
            (a, s), (b, t) = sets[x], sets[y]
            shared = len(s & t)
            if s and t and a is not None and b is not None and a != b and 100 * shared >= percent * (len(s) + len(t) - shared):
                links.append((a, b))
    root = roots({i for i, _ in sets if i is not None}, links)
    return [(i, len(s), root.get(i), i is None or root[i] == i) for i, s in sets]


def same(df, wanted):
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(wanted, key=key)
