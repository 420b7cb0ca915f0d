"""Language identification by interpolated Kneser-Ney character models, one per language, in sorted hash arrays."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import Workspace, emit, inputs, lean, results, sample_each, small_batches
from .words import Lexicon, mix, slices, split_words

_LETTERS = regex.compile(r"\p{L}+")
_START, _END = "^", "$"  # never inside a run of letters
UNDETERMINED = "und"
#: A language with fewer calibration rows takes the deviations of all languages together.
MIN_CALIBRATION = 20
#: Squared nats: the loss of single characters varies as much at least, also where all calibration rows are alike.
LEAST_VARIANCE = 1.0


def runs_of(chunk: bytes) -> list[str]:
    """The runs of letters of a chunk between white space, in lower case."""
    text = chunk.decode("utf-8")
    return [text.lower()] if text.isalpha() else [r.lower() for r in _LETTERS.findall(text)]


def _plain(code: int) -> int:
    """The lower-case letter that a character stands for, 0 if it is none, -1 if that depends on its neighbours or takes several characters."""
    char = chr(code)
    low = char.lower()
    if len(low) > 1 or char == "Σ" or char.isalpha() != bool(_LETTERS.fullmatch(char)):
        return -1
    return ord(low) if char.isalpha() else 0


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def framed(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the runs between start and end marks, one after another, and the length of each with its marks."""
    return code_points("".join(_START + r + _END for r in runs)), np.fromiter((len(r) + 2 for r in runs), np.int64, len(runs))


def framed_runs(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`framed` runs of letters of chunks between white space, as :func:`runs_of` gives them, and the chunk of each run."""
    codes = code_points(b" ".join(chunks).decode("utf-8"))
    kinds, at = np.unique(codes, return_inverse=True)
    table = np.array([_plain(c) for c in kinds.tolist()], np.int64)
    if (table < 0).any():
        runs = [(i, r) for i, chunk in enumerate(chunks) for r in runs_of(chunk)]
        return *framed([r for _, r in runs]), np.array([i for i, _ in runs], np.int64)
    letters = table[at]
    solid = np.concatenate([[False], letters > 0, [False]])
    starts, ends = np.flatnonzero(solid[1:] & ~solid[:-1]), np.flatnonzero(solid[:-1] & ~solid[1:])
    lengths = ends - starts + 2
    first = np.cumsum(lengths) - lengths
    out = np.zeros(int(lengths.sum()), np.uint32)
    inside = np.ones(len(out), bool)
    inside[first] = inside[first + lengths - 1] = False
    out[first], out[first + lengths - 1], out[inside] = ord(_START), ord(_END), letters[letters > 0]
    return out, lengths, np.cumsum(codes == ord(" "))[starts] if len(starts) else starts


def gram_hashes(codes: np.ndarray, lengths: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1..order-grams that end at each character of the framed runs, and each character's place in its run."""
    codes = codes.astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    hashes = [mix(codes + np.uint64(1))]
    for _ in range(order - 1):
        longer = np.zeros_like(codes)
        longer[1:] = mix(hashes[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:])
        hashes.append(longer)
    return hashes, place


def hashes_of(grams: list[str]) -> np.ndarray:
    """The hashes of grams of one length."""
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes = codes.reshape(len(grams), -1)
    out = mix(codes[:, 0] + np.uint64(1))
    for c in range(1, codes.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[:, c])
    return out


class KneserNey:
    """The models of all languages: per order one ascending array of gram hashes and, per language, the
    interpolated probability; per context length one array of context hashes and the back-off weights."""

    def __init__(self, languages: list[str], order: int):
        self.languages, self.order = languages, order
        nothing = (np.zeros(0, np.uint64), np.zeros((0, len(languages))))
        self.grams, self.contexts = [nothing] * order, [nothing] * (order - 1)
        self.unseen = np.ones(len(languages))
        self.limits: dict[str, tuple[float, float, float]] = {}

    @classmethod
    def from_state(cls, state: dict) -> "KneserNey":
        model = cls(state["languages"], state["order"])
        model.__dict__.update(state)
        return model

    @classmethod
    def of(cls, languages: list[str], order: int, uniform: float, entries: pa.Table) -> "KneserNey":
        """``entries``: per gram of a language its length n, its hash and those of the gram without its last and without its first
        character, its discounted ``share`` and the ``weight`` of its context. An entry's shorter grams have entries too.

        A gram has the same form in every language: its share, 0 where the language lacks it, plus the context's weight, 1
        where the language lacks that, times what the shorter gram has.
        """
        model = cls(languages, order)
        model.grams, model.contexts = [], []
        held = {c: entries.column(c).to_numpy() for c in entries.column_names if c != "lang"}
        places = {l: k for k, l in enumerate(languages)}
        lang = np.array([places[l] for l in entries.column("lang").to_pylist()], np.int64)
        lower_keys, lower = np.zeros(1, np.uint64), np.full((1, len(languages)), uniform)
        for n in range(1, order + 1):
            rows = np.flatnonzero(held["n"] == n)
            owner = lang[rows]
            gram, context, shorter = (held[c][rows].view(np.uint64) for c in ("hash", "context", "shorter"))
            keys, first, at = np.unique(gram, return_index=True, return_inverse=True)
            contexts, where = np.unique(context, return_inverse=True)
            weights = np.ones((len(contexts), len(languages)))
            weights[where, owner] = held["weight"][rows]
            shares = np.zeros((len(keys), len(languages)))
            shares[at, owner] = held["share"][rows]
            values = shares + weights[where[first]] * lower[np.searchsorted(lower_keys, shorter[first])]
            if n == 1:
                model.unseen = (weights[0] if len(weights) else np.ones(len(languages))) * uniform
            else:
                model.contexts.append((contexts, weights))
            model.grams.append((keys, values))
            lower_keys, lower = keys, values
        return model

    def limit(self, lang: str, events: int, z: float) -> float:
        """The largest loss per event with which a text of that many events is taken for the language."""
        if lang not in self.limits:
            return np.inf  # nothing was calibrated at all
        mean, spread, per_event = self.limits[lang]
        return mean + z * np.sqrt(spread + max(per_event, LEAST_VARIANCE) / events)

    def log_probs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed natural log-probabilities per run and language, and the number of events of each run."""
        return self.framed_log_probs(*framed(runs))

    def framed_log_probs(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`log_probs` of runs that are framed already."""
        hashes, place = gram_hashes(codes, lengths, self.order)
        n_lang = len(self.languages)
        value = np.ones((len(place), n_lang))
        done = place == 0
        for n in range(self.order, 0, -1):
            reach = ~done & (place >= n - 1)
            at = np.flatnonzero(reach)
            keys, probs = self.grams[n - 1]
            hit, where = _find(keys, hashes[n - 1][at])
            value[at[hit]] *= probs[where[hit]]
            done[at[hit]] = True
            at = at[~hit]
            if n > 1:
                keys, weights = self.contexts[n - 2]
                hit, where = _find(keys, hashes[n - 2][at - 1])
                value[at[hit]] *= weights[where[hit]]
            else:
                value[at] *= self.unseen
        logs = np.log(value)
        logs[place == 0] = 0
        starts = np.cumsum(lengths) - lengths
        return np.add.reduceat(logs, starts, axis=0), lengths - 1


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted, at


def _count_grams(order: int, most: int = 1_000_000):
    """Turns the distinct words of each slice of a language into grams by whole arrays and sums those in one dictionary for each task,
    which is given out when it has more than ``most`` of them."""

    @lean
    def run(batches):
        grams: dict = defaultdict(int)

        def give_out():
            found = list(grams)
            columns = [pa.array([l for l, _ in found], pa.string()), pa.array([g for _, g in found], pa.string()), pa.array(grams.values(), pa.int64())]
            grams.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "c"])

        for batch in batches:
            for part in slices(batch):
                langs = part.column("lang")
                for lang in pc.unique(langs).to_pylist():
                    words = split_words(part.column("text").filter(pc.equal(langs, lang)))
                    _, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                    codes, lengths, owner = framed_runs(words.take(first))
                    for gram, c in count_grams(codes, lengths, n[owner], order):
                        grams[lang, gram] += c
                if len(grams) > most:
                    yield give_out()
        yield give_out()

    return run


def count_grams(codes: np.ndarray, lengths: np.ndarray, often: np.ndarray, order: int) -> list[tuple[str, int]]:
    """How often each gram ends an event of the framed runs, which occur ``often``: the last ``order`` characters up to there, fewer where
    the run begins with them."""
    hashes, place = gram_hashes(codes, lengths, order)
    text = codes.tobytes().decode("utf-32-le", "surrogatepass")
    often = np.repeat(often, lengths)
    out = []
    for n in range(min(2, order), order + 1):
        at = np.flatnonzero(place >= max(1, n - 1) if n == order else place == n - 1)
        _, first, which = np.unique(hashes[n - 1][at], return_index=True, return_inverse=True)
        sums = np.bincount(which, often[at], len(first)).astype(np.int64)  # whole numbers, exact below 2^53
        out += [(text[e - n + 1:e + 1], c) for e, c in zip(at[first].tolist(), sums.tolist())]
    return out


def _levels(work: Workspace, counted: DataFrame, order: int) -> DataFrame:
    """(fit, lang, n, gram, c, seen) of all grams of 1..``order`` characters from ``counted`` (fit, lang, gram, c).

    Below the highest order a gram counts the distinct characters before it (``c``), except where it begins a run and nothing can
    precede it; ``seen`` is how many events it ended, never fewer than those of a longer gram that it ends.
    """
    key, length = ["fit", "lang", "gram"], F.length("gram")
    counted = work.save(counted.groupBy(*key).agg(F.sum("c").alias("c"), F.sum("c").alias("seen")))
    levels: list[DataFrame] = []
    for n in range(order, 0, -1):
        level = counted.where(length == n)
        if levels:
            shorter = levels[-1].select("fit", "lang", F.expr("substring(gram, 2)").alias("gram"), F.lit(1).cast("long").alias("c"), "seen")
            level = level.unionByName(shorter).groupBy(*key).agg(F.sum("c").alias("c"), F.sum("seen").alias("seen"))
        levels.append(work.save(level))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.withColumn("n", length)


@lean
def _hashed(batches):
    """Grams as the hashes of themselves and of what is left without their last or first character; 0 for none."""
    for batch in batches:
        grams, n = batch.column("gram").to_pylist(), batch.column("n").to_numpy()
        out = np.zeros((3, len(grams)), np.uint64)
        for k in np.unique(n).tolist():
            at = np.flatnonzero(n == k)
            held = [grams[i] for i in at.tolist()]
            for row, part in zip(out, (slice(None), slice(0, -1), slice(1, None))):
                row[at] = hashes_of([g[part] for g in held]) if k > 1 or part == slice(None) else 0
        columns = [batch.column("lang"), batch.column("n"), *(pa.array(row.view(np.int64)) for row in out), batch.column("share"), batch.column("weight")]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "hash", "context", "shorter", "share", "weight"])


def fit(counted: DataFrame, order: int, max_grams: int) -> dict[str, KneserNey]:
    """Interpolated Kneser-Ney models by ``fit``, with one absolute discount per order, from counts (fit, lang, gram, c) of how often each gram ended an event. Grams
    shorter than ``order`` begin a run.

    Discounts, continuation counts, context totals and alphabets come from all grams, by grouping. Only then does a model with more than
    ``max_grams`` grams in a language put the ones seen least often aside, by whole classes of about one sixteenth of a doubling, longer
    grams first, so that a gram is never kept without its shorter ones. Their shares go to the weights of their contexts, so every
    distribution still adds up to one. A context has one row for each character at most, so no group grows with the corpus.
    """
    spark = counted.sparkSession
    work = Workspace(spark, "kneser-ney")
    # a class: rarer ones have greater numbers, and of one frequency the longer grams
    rarity = F.struct((-F.floor(16 * F.log2("seen"))).cast("long").alias("rare"), F.col("n"))
    levels = _levels(work, counted, order).withColumn("class", rarity)
    classes = work.save(levels.groupBy("fit", "lang", "n", "class").agg(
        F.count("*").alias("grams"), F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos")))
    ones, twos = F.sum("ones"), F.sum("twos")
    discounts = classes.groupBy("fit", "lang", "n").agg(F.when(ones > 0, ones / (ones + 2 * twos)).otherwise(0.5).alias("discount"))
    upto = F.sum("grams").over(Window.partitionBy("fit", "lang").orderBy("class"))  # a few thousand classes a language
    last = classes.withColumn("upto", upto).where(F.col("upto") <= max_grams).groupBy("fit", "lang").agg(F.max("class").alias("last"))
    facts = work.save(discounts.join(last, ["fit", "lang"], "left"))
    context = Window.partitionBy("fit", "lang", F.expr("left(gram, n - 1)"), "n")
    held = F.coalesce(F.col("class") <= F.col("last"), F.lit(False))
    over = F.col("c") - F.col("discount")
    total = F.sum("c").over(context)
    aside = F.sum(F.when(held, 0.0).otherwise(over)).over(context)
    kept = levels.join(facts, ["fit", "lang", "n"]).select(
        "fit", "lang", "n", "gram", held.alias("held"), (over / total).alias("share"),
        ((F.col("discount") * F.count("*").over(context) + aside) / total).alias("weight")).where("held").drop("held")
    kept = work.save(kept)
    symbols = dict(work.save(levels.where("n = 1").select("fit", "gram").distinct()).groupBy("fit").count().collect())
    languages: dict[str, list[str]] = {}
    for r in facts.select("fit", "lang").distinct().sort("fit", "lang").collect():
        languages.setdefault(r["fit"], []).append(r["lang"])
    models = {}
    for name, langs in languages.items():
        hashed = kept.where(F.col("fit") == name).select("lang", "n", "gram", "share", "weight").mapInArrow(
            _hashed, "lang string, n int, hash long, context long, shorter long, share double, weight double")
        models[name] = KneserNey.of(langs, order, 1.0 / (symbols[name] + 1), hashed.toArrow())
    work.clear()
    return models


def train(labelled: DataFrame, order: int = 4, max_grams: int = 400_000, calibration_docs: int | None = None) -> KneserNey:
    """Models of every non-null ``lang`` of ``labelled`` (doc_id, text, lang); null texts count as empty.

    Grams are counted over all rows, combined inside each task and then by Spark, and fitted by :func:`fit`; what is collected and broadcast are at most
    ``max_grams`` fitted grams of a language. The rejection limits are fitted on all rows too, each scored by models of the half of the rows that
    it is not in, as far as those take it for its language; a caller may ask for the ``calibration_docs`` ids of each language with the
    smallest hash instead. A language with fewer than ``MIN_CALIBRATION`` rows takes the deviations of all
    languages, and without any also their mean; if no row was held back from anything, the model's own losses count.
    """
    small_batches(labelled.sparkSession)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    labelled = labelled.where("lang is not null").select("doc_id", "text", "lang")
    marked = labelled.select(F.concat(half.cast("string"), "lang").alias("lang"), "text")
    counted = marked.mapInArrow(_count_grams(order), "lang string, gram string, c long")
    # one model of all rows, and one of each half
    fits = F.explode(F.array(F.lit("all"), F.left("lang", F.lit(1)))).alias("fit")
    models = fit(counted.select(fits, F.expr("substring(lang, 2)").alias("lang"), "gram", "c"), order, max_grams)
    model = models.get("all") or KneserNey([], order)
    chosen = labelled if calibration_docs is None else sample_each(labelled, "lang", calibration_docs)
    halves = {k: models.get(str(1 - k)) or KneserNey([], order) for k in (0, 1)}
    moments = _moments(chosen.withColumn("half", half), halves) or _moments(chosen.withColumn("half", F.lit(0)), {0: model})
    model.limits = _limits(model.languages, moments)
    return model


def _losses(shared):
    """(lang, loss, n) of the texts with letters that the model of their ``half`` takes for their own language."""

    @lean
    def run(batches):
        scorers = {half: Scorer(KneserNey.from_state(state)) for half, state in shared.value.items()}
        for batch in batches:
            for half, scorer in scorers.items():
                for part in slices(batch.filter(pc.equal(batch.column("half"), half))):
                    sums = scorer.score(part.column("text"))
                    if sums.shape[1] == 1:
                        continue  # no language was learned
                    best, n = np.argmin(sums[:, :-1], axis=1), sums[:, -1].round().astype(np.int64)
                    own = np.array(scorer.model.languages, object)[best] == np.array(part.column("lang").to_pylist(), object)
                    at = np.flatnonzero(own & (n > 0))
                    columns = [part.column("lang").take(pa.array(at)), pa.array(sums[at, best[at]] / n[at]), pa.array(n[at])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "loss", "n"])

    return run


def _moments(docs: DataFrame, models: dict[int, KneserNey]) -> dict[str, tuple[int, float, float, float]]:
    """Per language: rows, mean loss of an event, variance between rows, and variance of one event, of ``docs`` (half, lang, text) by the
    model of each half."""
    spark = docs.sparkSession
    work = Workspace(spark, "calibration")
    shared = spark.sparkContext.broadcast({half: vars(m) for half, m in models.items()})
    losses = work.save(docs.select("half", "lang", "text").mapInArrow(_losses(shared), "lang string, loss double, n long"))
    shared.destroy()
    means = losses.groupBy("lang").agg((F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("mean"))
    held = losses.join(F.broadcast(means), "lang")
    per_event = F.avg(F.col("n") * (F.col("loss") - F.col("mean")) ** 2)
    rows = held.groupBy("lang").agg(F.count("*"), F.first("mean"), F.var_pop("loss"), per_event).collect()
    work.clear()
    return {r[0]: tuple(r[1:]) for r in rows}


def _limits(languages: list[str], moments: dict[str, tuple[int, float, float, float]]) -> dict[str, tuple[float, float, float]]:
    """Mean and variances of every language; those of all languages together, each by its rows, where one has too few rows."""
    if not moments:
        return {}
    rows = np.array(list(moments.values()), float)
    pooled = np.average(rows[:, 1:], axis=0, weights=rows[:, 0])
    out = {}
    for lang in languages:
        count, mean, *spreads = moments.get(lang, (0, *pooled))
        out[lang] = (mean, *(spreads if count >= MIN_CALIBRATION else pooled[1:]))
    return {lang: tuple(map(float, v)) for lang, v in out.items()}


class Scorer:
    """Cross-entropies of texts, one evaluation per distinct chunk between white space."""

    def __init__(self, model: KneserNey):
        self.model, self.width = model, len(model.languages) + 1
        self.lexicon = Lexicon(self._score)

    def _score(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        codes, lengths, owner = framed_runs(chunks)
        out = np.zeros((len(chunks), self.width))
        if len(lengths):
            logs, events = self.model.framed_log_probs(codes, lengths)
            first = np.flatnonzero(np.diff(owner, prepend=-1))  # the runs of a chunk lie together
            out[owner[first]] = np.add.reduceat(np.column_stack([-logs, events]), first, axis=0)
        return out.ravel(), np.full(len(chunks), self.width, np.int64)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Per text: summed loss by language, then the number of events."""
        words = split_words(texts)
        rows, counts = self.lexicon.rows(words), words.counts
        if not len(rows):
            return np.zeros((len(texts), self.width))
        values = self.lexicon.values[: self.lexicon.used].reshape(-1, self.width)[rows]
        total = np.vstack([np.zeros(self.width), np.cumsum(values, axis=0)])
        ends = np.cumsum(counts)
        return np.where(counts[:, None] > 0, total[ends] - total[ends - counts], 0.0)


_RESULT = "doc_id long, lang_pred string, score double, cross_entropy double, events long, rejected boolean"


def _identify(shared, z: float):
    @lean
    def run(batches):
        model = KneserNey.from_state(shared.value)
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch):
                sums = scorer.score(part.column("text"))
                events = sums[:, -1].round().astype(np.int64)
                names, scores, losses, rejected = [], [], [], []
                for total, n in zip(sums[:, :-1], events.tolist()):
                    if n == 0 or not len(total):
                        names.append(UNDETERMINED), scores.append(0.0), losses.append(None), rejected.append(True)
                        continue
                    loss = total / n
                    best = int(np.argmin(loss))
                    lang = model.languages[best]
                    names.append(lang)
                    scores.append(float(1 / np.exp(-(loss - loss[best]) * min(n, 100)).sum()))
                    losses.append(float(loss[best]))
                    rejected.append(bool(loss[best] > model.limit(lang, n, z)))
                yield emit(
                    part, lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()),
                    cross_entropy=pa.array(losses, pa.float64()), events=pa.array(events), rejected=pa.array(rejected, pa.bool_()))

    return run


def identify(docs: DataFrame, model: KneserNey, z: float = 8.0, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, cross_entropy, events, rejected.

    The prediction is the language with the lowest cross-entropy per character event (ties: the first by name); runs
    of letters are scored in lower case between a start and an end mark. ``score`` is the softmax share of
    the winner, with the evidence of at most 100 events. A document is rejected when its loss lies more than ``z`` calibrated
    deviations above its language's mean, whatever the alphabet of the corpus; the deviation has
    a part that shrinks with the number of events, so short texts are not rejected for being short.

    Texts that are null or have no letter get ``und``, score 0 and are rejected, as do all texts when no language was
    learned. Only the text is read; with ``carry`` the whole row comes along as ``document``. Repeated rows each give a row; an empty table gives none. One map over the
    rows, no shuffle; the broadcast model is bounded by ``max_grams`` per language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    given = inputs(docs, carry)
    return given.mapInArrow(_identify(shared, z), results(_RESULT, given))


def held_out(column: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2
