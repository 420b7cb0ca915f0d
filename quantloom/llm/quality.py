"""Quality of texts by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace, emit, inputs, lean, results, text_of
from .words import SPACE, Words, mix, slices, text_bytes

#: Size of the hashed weight vector; one more weight is the constant.
BITS = 20
_LETTER, _DIGIT, _MARK = 1, 2, 3
#: Stands for every bigram of a word and itself, beside the bigram's own hash.
_REPEAT = mix(np.array([0x7265706561740000], np.uint64)) >> np.uint64(64 - BITS)
_KIND = np.array([
    0 if SPACE[c] else _LETTER if c >= 128 or chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _MARK for c in range(256)], np.uint8)


def split_lexemes(texts: pa.Array) -> Words:
    """Runs of letters, of digits and of other marks, case kept. Every byte above 127 counts as a letter."""
    raw, offsets = text_bytes(texts)
    kind = _KIND[raw]
    begins = np.ones(len(raw), bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins[offsets[offsets < len(raw)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(raw)) if len(starts) else starts
    solid = kind[starts] > 0
    return Words(raw, starts[solid], ends[solid], offsets)


def ngram_features(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the texts, one after another: bucket and value of each feature, and how many each text has.

    Features are the 1- to ``width``-grams of its lexemes, hashed; where a lexeme follows itself, also the bigram "a word and the same
    again". The value is the number of occurrences, scaled so that a row has length 1."""
    words = split_lexemes(texts)
    doc = np.repeat(np.arange(len(words.counts), dtype=np.uint64), words.counts)
    gram, at = words.hashes, doc
    keys = []
    for n in range(1, width + 1):
        if n > 1:
            gram, at = mix(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + words.hashes[n - 1:]), doc[n - 1:]
            inside = doc[: len(at)] == at
        else:
            inside = np.ones(len(gram), bool)
        keys.append((at[inside] << np.uint64(BITS)) | (mix(gram[inside] + np.uint64(n)) >> np.uint64(64 - BITS)))
        if n == 2:
            again = at[inside & (words.hashes[1:] == words.hashes[:-1])]
            keys.append((again << np.uint64(BITS)) | _REPEAT)
    found, often = np.unique(np.concatenate(keys), return_counts=True)
    owner = (found >> np.uint64(BITS)).astype(np.int64)
    values = often.astype(np.float64)
    counts = np.bincount(owner, minlength=len(texts))
    values /= np.sqrt(np.bincount(owner, values * values, len(texts)))[owner]
    return (found & np.uint64((1 << BITS) - 1)).astype(np.int32), values, counts


class Leader:
    """FTRL-proximal: per weight the sum of adjusted gradients ``z`` and of their squares ``n``; weights follow from them."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        excess = np.maximum(np.abs(z) - self.l1, 0)
        return -np.sign(z) * excess / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        """One row: its distinct weights, their values and its label."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - y) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def _rows(width: int):
    @lean
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                at, x, counts = ngram_features(part.column("text"), width)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(x, pa.float64()))], names=["doc_id", "label", "at", "x"])

    return run


def _fit_shard(epochs: int, settings: tuple):
    def run(rows: pa.Table) -> pa.Table:
        order = rows.column("place").combine_chunks().to_numpy()
        order = np.argsort(order, kind="stable")
        rows = rows.combine_chunks()
        at, x = rows.column("at").chunk(0), rows.column("x").chunk(0)
        cuts = at.offsets.to_numpy()
        flat, values = at.values.to_numpy(), x.values.to_numpy()
        labels = rows.column("label").to_numpy()
        leader = Leader(*settings)
        for _ in range(epochs):
            for i in order.tolist():
                s, e = cuts[i], cuts[i + 1]
                leader.update(np.append(flat[s:e], 1 << BITS), np.append(values[s:e], 1.0), labels[i])
        w = leader.weights(slice(None))
        some = np.flatnonzero(leader.n)
        return pa.table({"bucket": pa.array(some, pa.int64()), "w": w[some], "n": leader.n[some]})

    return run


def train(
    labelled: DataFrame, width: int = 2, max_docs: int = 24_000, shards: int = 8, epochs: int = 8,
    alpha: float = 3.0, beta: float = 1.0, l1: float = 0.1, l2: float = 0.01,
) -> np.ndarray:
    """Weights of the hashed n-grams, the constant last, from ``labelled`` (doc_id, text, label 0 or 1).

    At most ``max_docs`` ids are learned from, those with the smallest hash, with whole texts; rows without id or label are left out, and so are ids
    with both labels. An id that occurs with several texts counts once, with the smallest. The rows are dealt to ``shards`` by a hash;
    each shard is one pass of updates per epoch in the order of that hash, so a repeated task gives the same weights. The
    shards' weights are averaged, each weighted by the squared gradients it has seen of that feature. What reaches the driver is
    that average: one number for each of 2^20 buckets at most. Without labelled rows all weights are 0 and every score is 0.5.
    """
    spark = labelled.sparkSession
    work = Workspace(spark, "quality")
    known = labelled.where("doc_id is not null and label in (0, 1)")
    ids = known.groupBy("doc_id").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low = high")
    ids = work.save(ids.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    texts = known.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(text_of()).alias("text"), F.min(F.col("label").cast("double")).alias("label"))
    rows = texts.mapInArrow(_rows(width), "doc_id long, label double, at array<int>, x array<double>")
    place = F.xxhash64(F.lit("place"), "doc_id")
    rows = work.save(rows.withColumn("place", place).withColumn("shard", F.pmod("place", F.lit(shards))))
    fitted = rows.groupBy("shard").applyInArrow(_fit_shard(epochs, (alpha, beta, l1, l2)), "bucket long, w double, n double")
    mixed = fitted.groupBy("bucket").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).where("w <> 0").toArrow()
    weights = np.zeros((1 << BITS) + 1, np.float32)
    weights[mixed.column("bucket").to_numpy()] = mixed.column("w").to_numpy()
    return weights


def _score(shared, width: int, threshold: float):
    @lean
    def run(batches):
        weights = shared.value.astype(np.float64)
        for batch in batches:
            for part in slices(batch):
                at, x, counts = ngram_features(part.column("text"), width)
                owner = np.repeat(np.arange(len(counts)), counts)
                product = np.bincount(owner, weights[at] * x, len(counts)) + weights[-1]
                score = 1 / (1 + np.exp(-np.clip(product, -30, 30)))
                yield emit(
                    part, score=pa.array(score, pa.float64()), predicted=pa.array((score >= threshold).astype(np.int32)),
                    n_features=pa.array(counts, pa.int64()))

    return run


_RESULT = "doc_id long, score double, predicted int, n_features long"


def score(docs: DataFrame, weights: np.ndarray, width: int = 2, threshold: float = 0.3, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted (score >= ``threshold``), n_features.

    The score is the probability of label 1: the sparse dot product of the whole text's features and the weights, plus the constant, through the logistic
    function. Null and empty texts have no features, so the constant alone decides. Only the text is read; with ``carry`` the whole row comes along as
    ``document``. Repeated rows each give a row; null ids stay null; an empty table gives none. One map over the rows with
    a broadcast vector of fixed size (4 MB), no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    given = inputs(docs, carry)
    return given.mapInArrow(_score(shared, width, threshold), results(_RESULT, given))


def held_out(column: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0. Rows without id are not held out, but nothing is learned from them."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))
