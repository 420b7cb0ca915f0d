"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near_dedup import signatures
from .shingles import Shingler
from .tables import Workspace, emit, inputs, lean, results, sample
from .words import Lexicon, slices, split_words

#: A chain is at most this many consecutive words; longer texts are consecutive chains.
CHAIN = 64
#: Size of the hashed weight vector (4 bytes each).
DIMENSIONS = 1 << 20
_EDGE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
_WORDS = regex.compile(r"[^ \t-\r]+")


def normal(chunk: bytes) -> str:
    """A word as the model sees it: lower case, without punctuation at its ends."""
    return _EDGE.sub("", chunk.decode("utf-8").lower())


def stems(word: str) -> list[str]:
    """The word and its beginnings, by which labelled documents are turned into labelled tokens."""
    return [f"w {word}"] + [f"{k} {word[:k]}" for k in range(4, 9) if len(word) > k]


def features(word: str) -> list[str]:
    return [f"w {word}", *(f"p{k} {word[:k]}" for k in range(3, 9)), f"s3 {word[-3:]}", "b"]


N_FEATURES = 9


def feature_ids(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(f) % DIMENSIONS for w in words for f in features(w)), np.int64, len(words) * N_FEATURES).reshape(-1, N_FEATURES)


def chains(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a batch's words in a chains x CHAIN grid: chain and position of each word. No chain crosses documents."""
    per_doc = -(-counts // CHAIN)
    first = np.cumsum(per_doc) - per_doc
    starts = np.cumsum(counts) - counts
    inside = np.arange(int(counts.sum())) - np.repeat(starts, counts)
    return np.repeat(first, counts) + inside // CHAIN, inside % CHAIN


def forward_backward(odds: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds form of the two-state recursion. ``odds``: exp of the label-1 score per cell; ``moves``: 2 x 2 factors.

    Returns per cell the forward odds (own score included) and the backward odds; their product is the odds of label 1."""
    chains_, length = odds.shape
    forward = np.ones((chains_, length))
    backward = np.ones((chains_, length))
    (m00, m01), (m10, m11) = moves
    forward[:, 0] = odds[:, 0]
    for t in range(1, length):
        r = forward[:, t - 1]
        forward[:, t] = odds[:, t] * (m01 + m11 * r) / (m00 + m10 * r)
    for t in range(length - 2, -1, -1):
        x = odds[:, t + 1] * backward[:, t + 1]
        b = (m10 + m11 * x) / (m00 + m01 * x)
        backward[:, t] = np.where(mask[:, t + 1], b, 1.0)
    return forward, backward


class ChainModel:
    """Emission weights over hashed features, and a 2 x 2 matrix of transition scores (the 0 -> 0 score is 0)."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None, calibration: np.ndarray | None = None):
        self.weights = np.zeros(DIMENSIONS, np.float32) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves
        self.calibration = np.array([-8.0, 0, 0, 0, 0]) if calibration is None else calibration

    def summary(self) -> dict:
        return {"nonzero": int(np.count_nonzero(self.weights)), "moves": self.moves.round(2).tolist()}

    def emissions(self, words: list[str]) -> np.ndarray:
        return self.weights[feature_ids(words)].sum(axis=1) if words else np.zeros(0)

    def marginals(self, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of label 1 per word of a batch."""
        if not len(scores):
            return np.zeros(0)
        chain, place = chains(counts)
        odds, mask = self._grid(scores, chain, place)
        forward, backward = forward_backward(odds, mask, np.exp(self.moves))
        both = (forward * backward)[chain, place]
        return both / (1 + both)

    def scores(self, marginals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Documents' probabilities of being toxic from their words' marginals; 0 for texts without words."""
        x = evidence_of(marginals, counts) @ self.calibration
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(x, -30, 30))), 0.0)

    @staticmethod
    def _grid(scores, chain, place):
        mask = np.zeros((int(chain[-1]) + 1, CHAIN), bool)
        mask[chain, place] = True
        odds = np.ones(mask.shape)
        odds[chain, place] = np.exp(np.clip(scores, -30, 30))
        return odds, mask

    def gradient(self, ids: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the conditional log-likelihood of labelled words, by the score of each word, and by the transition scores.

        ``ids``: the hashed features of the words of documents with ``counts`` words."""
        if not len(ids):
            return np.zeros(0), np.zeros((2, 2))
        chain, place = chains(counts)
        odds, mask = self._grid(self.weights[ids].sum(axis=1), chain, place)
        y = np.zeros(mask.shape)
        y[chain, place] = labels
        m = np.exp(self.moves)
        forward, backward = forward_backward(odds, mask, m)
        joint = forward * backward
        miss = (y - joint / (1 + joint))[chain, place]
        pair = mask[:, 1:]
        r, x = forward[:, :-1], odds[:, 1:] * backward[:, 1:]
        cell = np.stack([m[0, 0] * np.ones_like(r), m[0, 1] * x, m[1, 0] * r, m[1, 1] * r * x])
        cell /= cell.sum(axis=0)
        a, b = y[:, :-1], y[:, 1:]
        seen = np.stack([(1 - a) * (1 - b), (1 - a) * b, a * (1 - b), a * b])
        by_move = ((seen - cell) * pair).sum(axis=(1, 2)).reshape(2, 2)
        by_move[0, 0] = 0
        return miss, by_move


class Ascent:
    """Gradient steps of adaptive size (Adam) for weights and transition scores."""

    def __init__(self, size: int, decay: float = 1e-6):
        self.w, self.moves, self.decay, self.step = np.zeros(size), np.zeros((2, 2)), decay, 0
        self.state = [np.zeros_like(v) for v in (self.w, self.w, self.moves, self.moves)]

    def move(self, grad_w: np.ndarray, grad_m: np.ndarray, n: int) -> None:
        """One step by the summed gradients of ``n`` words."""
        self.step += 1
        grad_w = grad_w - self.decay * max(1, n) * self.w
        for value, grad, first, second, rate in (
                (self.w, grad_w, *self.state[:2], 0.3), (self.moves, grad_m, *self.state[2:], 0.1)):
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            value += rate * (first / (1 - 0.9**self.step)) / (np.sqrt(second / (1 - 0.999**self.step)) + 1e-8)


def _marks(words: list[str]) -> dict[str, list[str]]:
    """The document's words by stem, and by "several words of the stem" where it has two occurrences or more."""
    by_stem: dict[str, list[str]] = {}
    for w in words:
        for s in stems(w):
            by_stem.setdefault(s, []).append(w)
    return by_stem | {f"several {s}": found for s, found in by_stem.items() if len(found) > 1}


def significant(counts: DataFrame, n0: int, n1: int, evidence: float = 30.0, margin: float = 1.5) -> DataFrame:
    """The stems, and repeated stems, that count as toxic, of ``counts`` (stem, c0, c1: documents of each class that have it): smoothed log-odds
    of toxic against clean documents above ``margin``, and counts that are no accident (likelihood ratio of ``evidence`` or more)."""
    c0, c1, n = F.col("c0"), F.col("c1"), n0 + n1
    odds = F.log((c1 + 0.5) / (n1 + 1)) - F.log((c0 + 0.5) / (n0 + 1))
    clean = F.when(c0 > 0, c0 * F.log(c0 * n / ((c0 + c1) * max(1, n0)))).otherwise(0.0)
    ratio = c1 * F.log(c1 * n / ((c0 + c1) * max(1, n1))) + clean
    # fewer toxic documents than three cannot be evidence enough
    return counts.where((c1 >= 3) & (odds > margin) & (2 * ratio >= evidence)).select("stem")


#: Tasks of a gradient step.
SHARDS = 8
#: The fields that are fitted side by side: a trial on two thirds of the documents, and the one that is used.
FITS = ("trial", "whole")


def train(labelled: DataFrame, max_docs: int = 1000, rounds: int = 40) -> ChainModel:
    """Fits the field on at most ``max_docs`` whole documents of each class, those with the smallest hash of their id.

    ``labelled``: doc_id, text, toxic (rows with null label are left out). Document labels become token labels: in toxic documents, words whose
    stem is :func:`significant`. Near copies within a class teach once. The document calibration comes from a third of the documents, under a field fitted on
    the others. With no rows of a class the model scores every text the same.

    Stems are counted by grouping; a step of the fit is a job whose tasks add up the gradients of their documents. Texts, words and
    tokens stay in Spark: the driver holds weights and gradients of the features that occur, 2^20 at most, and 5 numbers of each calibration document.
    """
    spark = labelled.sparkSession
    work = Workspace(spark, "toxicity")
    rows = labelled.where("toxic in (0, 1)").select("doc_id", "text", "toxic")
    chosen = [sample(rows.where(F.col("toxic") == y), max_docs) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).where("text is not null").dropDuplicates()
    chosen = chosen.select(F.xxhash64("doc_id", "text").alias("key"), F.col("toxic").cast("int").alias("toxic"), "text").repartition(SHARDS)
    worded = work.save(chosen.mapInArrow(_worded, "key long, toxic int, words array<string>, marks array<long>"))
    docs = work.save(distinct_marks(worded).withColumn("third", F.pmod("key", F.lit(3)) == 0).repartition(SHARDS))
    size = {(r["toxic"], r["third"]): r["count"] for r in docs.groupBy("toxic", "third").count().collect()}
    if len({y for y, _ in size}) < 2:
        work.clear()
        return ChainModel()
    stems = docs.mapInArrow(_stems, "stem string, third boolean, toxic int, c long")
    total = lambda fit, y: F.sum(F.when((F.col("toxic") == y) & (F.lit(fit == "whole") | ~F.col("third")), F.col("c")).otherwise(0))
    counts = work.save(stems.groupBy("stem").agg(*(total(fit, y).alias(f"{fit}{y}") for fit in FITS for y in (0, 1))).where("whole1 >= 3"))
    found = {}
    for fit in FITS:
        n0, n1 = (sum(n for (label, third), n in size.items() if label == y and (fit == "whole" or not third)) for y in (0, 1))
        some = significant(counts.select("stem", F.col(f"{fit}0").alias("c0"), F.col(f"{fit}1").alias("c1")), n0, n1)
        found[fit] = {r["stem"] for r in some.toLocalIterator()}
    marked = spark.sparkContext.broadcast(found)
    kinds = ", ".join(f"{fit} array<double>" for fit in FITS)
    cells = work.save(docs.mapInArrow(_cells(marked), f"third boolean, toxic int, n long, ids array<int>, {kinds}"))
    marked.destroy()
    models = _ascend(cells, rounds)
    trial = spark.sparkContext.broadcast((models["trial"].weights, models["trial"].moves))
    x = cells.where("third").select("toxic", "n", "ids").mapInArrow(_evidence(trial), "toxic int, x array<double>").toArrow()
    trial.destroy()
    model = models["whole"]
    if x.num_rows:
        model.calibration = calibrate(np.array(x.column("x").to_pylist()), x.column("toxic").to_numpy().astype(float))
    work.clear()
    return model


@lean
def _worded(batches):
    """Per document its words as the model sees them, and four MinHash values of its three-word shingles."""
    for batch in batches:
        for part in slices(batch):
            texts = part.column("text")
            words = [[normal(c) for c in t.encode("utf-8", "surrogatepass").split()] for t in texts.to_pylist()]
            marks = [[]] * len(texts)
            for i, values in _signed(texts):
                marks[i] = values
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("toxic"), pa.array(words, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int64()))],
                names=["key", "toxic", "words", "marks"])


def _signed(texts: pa.Array):
    """(place, four MinHash values) of the texts with words."""
    values, sizes = Shingler(3).flat(texts)
    some = np.flatnonzero(sizes)
    return zip(some.tolist(), signatures(values, sizes[some], 4).astype(np.int64).tolist()) if len(some) else []


def distinct_marks(worded: DataFrame) -> DataFrame:
    """:func:`unlike` for tables: the documents with words of which no MinHash value occurs in one with a smaller key."""
    at = ["toxic", "coordinate", "value"]
    marks = worded.select("key", "toxic", F.posexplode("marks").alias("coordinate", "value"))
    first = marks.groupBy(*at).agg(F.min("key").alias("first"))
    copies = marks.join(first, at).where("key > first").select("key", "toxic").distinct()
    return worded.where(F.size("marks") > 0).join(copies, ["key", "toxic"], "left_anti").select("key", "toxic", "words")


@lean
def _stems(batches):
    """How many of a task's documents have a stem, or a repeated stem."""
    counts: Counter = Counter()
    for batch in batches:
        for words, third, y in zip(*(batch.column(c).to_pylist() for c in ("words", "third", "toxic"))):
            counts.update((s, third, y) for s in _marks(words))
    for some in (list(counts)[i:i + 100_000] for i in range(0, len(counts), 100_000)):
        stem, third, y = zip(*some)
        yield pa.RecordBatch.from_arrays(
            [pa.array(stem), pa.array(third), pa.array(y, pa.int32()), pa.array([counts[k] for k in some], pa.int64())], names=["stem", "third", "toxic", "c"])


def _cells(marked):
    """Documents as features and token labels of each fit."""

    @lean
    def run(batches):
        for batch in batches:
            columns = [batch.column("third"), batch.column("toxic")]
            docs, toxic = batch.column("words").to_pylist(), batch.column("toxic").to_pylist()
            columns.append(pa.array([len(words) for words in docs], pa.int64()))
            columns.append(pa.array([feature_ids(words).ravel().astype(np.int32) for words in docs], pa.list_(pa.int32())))
            for fit in FITS:
                labels = []
                for words, y in zip(docs, toxic):
                    hit = {w for s, some in _marks(words).items() if s in marked.value[fit] for w in some} - {""} if y else set()
                    labels.append(np.array([w in hit for w in words], float))
                columns.append(pa.array(labels, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=["third", "toxic", "n", "ids", *FITS])

    return run


def _dense(used: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(DIMENSIONS)
    out[used] = values
    return out


def _step(shared):
    """The summed gradients of a task's documents: of each fit the words, and by transition and by feature that occurs."""

    def run(batches):
        used, state = shared.value
        models = {fit: ChainModel(_dense(used, w), moves) for fit, (w, moves) in state.items()}
        by_feature = {fit: np.zeros(DIMENSIONS) for fit in FITS}
        by_move, n, seen = np.zeros((len(FITS), 4)), [0] * len(FITS), np.zeros(DIMENSIONS, bool)
        for batch in batches:
            for k, fit in enumerate(FITS):
                part = batch if fit == "whole" else batch.filter(pc.invert(batch.column("third")))
                ids = part.column("ids").flatten().to_numpy().reshape(-1, N_FEATURES)
                counts, labels = part.column("n").to_numpy(), part.column(fit).flatten().to_numpy()
                miss, moves = models[fit].gradient(ids, counts, labels)
                by_feature[fit] += np.bincount(ids.ravel(), np.repeat(miss, N_FEATURES), DIMENSIONS)
                by_move[k] += moves.ravel()
                n[k] += len(ids)
                seen[ids] = True
        at = np.flatnonzero(seen)
        arrays = [n, at, *(by_feature[fit][at] for fit in FITS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a], pa.list_(t)) for a, t in zip([*arrays, by_move.ravel()], _STEP.values())], names=list(_STEP))

    return run


_STEP = {"n": pa.int64(), "at": pa.int32(), **{fit: pa.float64() for fit in FITS}, "moves": pa.float64()}


def _ascend(cells: DataFrame, rounds: int) -> dict[str, ChainModel]:
    """Both fields by ``rounds`` steps of Adam over all documents, one job for each step."""
    context = cells.sparkSession.sparkContext
    schema = ", ".join(f"{c} array<{ {pa.int64(): 'long', pa.int32(): 'int'}.get(t, 'double') }>" for c, t in _STEP.items())
    used, ascents = np.zeros(0, np.int32), {fit: Ascent(0) for fit in FITS}
    for step in range(rounds):
        shared = context.broadcast((used, {fit: (a.w, a.moves) for fit, a in ascents.items()}))
        parts = cells.mapInArrow(_step(shared), schema).toArrow()
        shared.destroy()
        at = [parts.column("at")[i].values.to_numpy() for i in range(parts.num_rows)]
        if not step:  # the features of all tasks; the next steps have the same
            used = np.unique(np.concatenate(at)) if at else used
            ascents = {fit: Ascent(len(used)) for fit in FITS}
        n = np.array(parts.column("n").to_pylist()).sum(axis=0)
        moves = np.array(parts.column("moves").to_pylist()).sum(axis=0).reshape(len(FITS), 2, 2)
        for k, (fit, ascent) in enumerate(ascents.items()):
            grad = np.zeros(len(used))
            for i, some in enumerate(at):
                grad[np.searchsorted(used, some)] += parts.column(fit)[i].values.to_numpy()
            ascent.move(grad, moves[k], int(n[k]))
    return {fit: ChainModel(_dense(used, a.w).astype(np.float32), a.moves) for fit, a in ascents.items()}


def _evidence(shared):
    def run(batches):
        model = ChainModel(*shared.value)
        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy().reshape(-1, N_FEATURES)
            counts = batch.column("n").to_numpy()
            x = evidence_of(model.marginals(model.weights[ids].sum(axis=1), counts), counts)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])

    return run


def unlike(texts: list[str]) -> list[str]:
    """The texts without near copies of earlier ones, whose shared rare words would pass for toxic ones: a text goes when
    one of four MinHash values of its three-word shingles has been seen."""
    seen: set = set()
    kept = []
    for i, coordinates in _signed(pa.array(texts, pa.string())):
        marks = set(enumerate(coordinates))
        if not marks & seen:
            kept.append(texts[i])
        seen |= marks
    return kept


def evidence_of(marginals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: 1, the log-odds of its most toxic word, and the logarithms of its expected number and share of toxic words
    and of its length."""
    out = np.zeros((len(counts), 5))
    out[:, 0] = 1
    some = counts > 0
    if some.any():
        n = counts[some]
        starts = (np.cumsum(counts) - counts)[some]
        high = np.clip(np.maximum.reduceat(marginals, starts), 1e-9, 1 - 1e-9)
        expected = np.add.reduceat(np.where(marginals >= 0.05, marginals, 0.0), starts)
        out[some, 1:] = np.column_stack([np.clip(np.log(high / (1 - high)), -8, 8), np.log1p(expected), np.log(expected / n + 1e-4), np.log(n)])
    return out


def calibrate(x: np.ndarray, y: np.ndarray, decay: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, weakly regularised."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - decay * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + decay * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def _score(shared, threshold: float, least: float):
    @lean
    def run(batches):
        model = ChainModel(*shared.value)

        def compute(chunks):
            return model.emissions([normal(c) for c in chunks]), np.ones(len(chunks), np.int64)

        lexicon = Lexicon(compute)
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                counts = words.counts
                p = model.marginals(lexicon.single(lexicon.rows(words)), counts)
                ends = np.cumsum(counts)
                out = model.scores(p, counts)
                spans = []
                for i, (n, end) in enumerate(zip(counts.tolist(), ends.tolist())):
                    at = np.flatnonzero(p[end - n:end] >= least)
                    spans.append(_spans(part.column("text")[i].as_py(), at) if len(at) else [])
                yield emit(
                    part, score=pa.array(out, pa.float64()), predicted=pa.array((out >= threshold).astype(np.int32)),
                    spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    return run


def _spans(text: str, at: np.ndarray) -> list[dict]:
    """Code point ranges of the words at these places; neighbours become one span."""
    places = [m.span() for m in _WORDS.finditer(text)]
    out: list[dict] = []
    last = -2
    for i in at.tolist():
        if i == last + 1:
            out[-1]["end"] = places[i][1]
        else:
            out.append({"start": places[i][0], "end": places[i][1]})
        last = i
    return out


_RESULT = "doc_id long, score double, predicted int, spans array<struct<start:long,end:long>>"


def score(docs: DataFrame, model: ChainModel, threshold: float = 0.3, span_threshold: float = 0.3, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted (score >= ``threshold``), spans (start, end in code points).

    Every word of the whole text gets its marginal probability of being toxic by forward-backward over its chain of
    at most 64 words. The document's score is a calibrated function of the largest marginal and of the expected number and
    share of toxic words; its spans are the words whose marginal is ``span_threshold`` or more. Null and empty texts score 0 and have no spans. Only the text is read; with
    ``carry`` the whole row comes along as ``document``. Repeated rows each give a row; an empty table gives none. One map over the rows with a broadcast model of fixed size (4 MB), no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.moves, model.calibration))
    given = inputs(docs, carry)
    return given.mapInArrow(_score(shared, threshold, span_threshold), results(_RESULT, given))
