"""The quality classifier: features and updates against plain loops, held-out accuracy, awkward tables."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quantloom.llm import quality

from .cases import awkward_rows, empty, prose, table


def lexemes(text):
    return re.findall(r"[^\W\d_\x00-\x7f]+|(?:[A-Za-z]|[^\x00-\x7f])+|[0-9]+|[^A-Za-z0-9 \t\n\x0b\x0c\r\x80-\U0010ffff]+", text)


def test_features_are_those_of_plain_counting():
    texts = ["one two two!! 34two é", "", None, "a a a", "!!??12", "漢字 x漢"]
    at, x, counts = quality.ngram_features(pa.array(texts), 2)
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts.tolist(), ends.tolist()):
        words = lexemes(text or "")
        grams = words + list(zip(words, words[1:])) + ["again" for a, b in zip(words, words[1:]) if a == b]
        often = {g: grams.count(g) for g in grams}
        norm = math.sqrt(sum(c * c for c in often.values()))
        assert n == len(often)
        assert np.allclose(sorted(x[end - n:end]), sorted(c / norm for c in often.values()))
    both = quality.ngram_features(pa.array(["one two"]), 2)[0].tolist()
    assert set(both) < set(at[: counts[0]].tolist())


def test_updates_follow_the_formulas():
    leader, rng = quality.Leader(0.5, 1.0, 0.2, 0.1), random.Random(2)
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.2 else -(z[i] - math.copysign(0.2, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 0.1)

    for _ in range(60):
        at = sorted(rng.sample(range(4), 2))
        x, y = [rng.random(), rng.random()], float(rng.random() < 0.6)
        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
        for i, wi, xi in zip(at, w, x):
            g = (p - y) * xi
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * wi
            n[i] += g * g
        leader.update(np.array(at), np.array(x), y)
    assert np.allclose(leader.weights(np.arange(4)), [weight(i) for i in range(4)])


def corpus():
    rows = []
    for i in range(400):
        text = prose(i, 30)
        good = i % 5 != 0
        rows.append((i, text if good else " ".join(w + "%%%" for w in text.split()) if i % 2 else " ".join([text.split()[0]] * 30), int(good)))
    return rows


def test_held_out_accuracy_and_repeatable_weights(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    learned = docs.where(~quality.held_out())
    weights = quality.train(learned, shards=2)
    assert np.array_equal(weights, quality.train(learned.repartition(2), shards=2))
    found = {r.doc_id: r for r in quality.score(docs, weights).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert len(held) > 50
    right = sum(found[i].predicted == y for i, _, y in held) / len(held)
    assert right >= 0.97
    # the score is the dot product of a text's own features
    at, x, _ = quality.ngram_features(pa.array([rows[3][1]]), 2)
    assert abs(found[3].score - 1 / (1 + math.exp(-(weights[at].astype(float) @ x + weights[-1])))) < 1e-9


def test_awkward_tables(spark):
    docs = table(spark, awkward_rows())
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, 1), (8, 0), (13, 1), (15, 0), (15, 1), (17, None), (None, 1)], "doc_id long, label int")
    weights = quality.train(docs.select("doc_id", "text").join(labels, "doc_id"))
    found = quality.score(docs, weights, carry=True)
    assert found.count() == len(awkward_rows()) and found.where("score is null or score < 0 or score > 1").count() == 0
    bare = quality.score(docs, weights).where("doc_id in (7, 8, 9)").collect()
    assert len({r.score for r in bare}) == 1 and all(r.n_features == 0 for r in bare)
    assert quality.score(empty(spark), weights).count() == 0
    untaught = quality.train(docs.select("doc_id", "text", F.lit(None).cast("int").alias("label")))
    assert not untaught.any() and {r.score for r in quality.score(docs, untaught).collect()} == {0.5}
