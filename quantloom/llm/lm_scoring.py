"""Cross-entropy difference: matched character n-gram models of a target and of the background score each document.

The models are Spark tables of all observed trigrams; a slice of documents is scored with the rows of its own trigrams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace, lean, text_of
from .words import slices, text_bytes

ORDER = 3
_START, _OTHER, _FIRST = 0, 1, 2  # symbols before the characters of the vocabulary
#: This many target ids or fewer are sent to every executor; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Bytes of text of the documents that are scored together.
CHUNK = 4 << 20
_BITS = 21  # a symbol of a trigram's key
_RARE = 0x110000  # the symbol of characters outside a given vocabulary


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, one after another, and how many each has."""
    raw, offsets = text_bytes(texts)
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.concatenate([np.zeros(1, np.int64), np.cumsum((raw & 0xC0) != 0x80)])
    return codes, np.diff(leads[offsets])


def trigrams(symbols: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The number of each symbol's trigram; the first two symbols of a text follow start marks."""
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
    s = symbols.astype(np.int64)
    one, two = np.zeros_like(s), np.zeros_like(s)
    one[1:], two[2:] = s[:-1], s[:-2]
    one[place < 1], two[place < 2] = _START, _START
    return (two * size + one) * size + s


class Vocabulary:
    """The characters both models know; all others are one symbol."""

    def __init__(self, characters: list[int]):
        self.size = _FIRST + len(characters)
        self.table = np.full(0x110000, _OTHER, np.uint16)
        self.table[np.array(characters, np.int64)] = np.arange(_FIRST, self.size)


def keys(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The key of each symbol's trigram: three numbers of 21 bits, that of a symbol being one more than it, of a start mark 0."""
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
    s = symbols.astype(np.int64) + 1
    one, two = np.zeros_like(s), np.zeros_like(s)
    one[1:], two[2:] = s[:-1], s[:-2]
    one[place < 1], two[place < 2] = _START, _START
    return (two << 2 * _BITS) + (one << _BITS) + s


def _symbols(part: pa.RecordBatch, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = code_points(part.column("text"))
    return (codes if known is None else np.where(np.isin(codes, known), codes, _RARE)), counts


def _chunks(names: list[str]):
    """Adds the number of the chunk: consecutive rows of one task with at most ``CHUNK`` bytes of text, or one longer row."""

    @lean
    def run(batches):
        chunk, held = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for part in slices(batch, limit=CHUNK // 4):
                if held + part.column("text").nbytes > CHUNK:
                    chunk, held = chunk + 1, 0
                held += part.column("text").nbytes
                columns = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(part.num_rows, chunk))], names=[*names, "chunk"])

    return run


def _count_trigrams(known: np.ndarray | None):
    """(chunk, gram, background, target) of every trigram of a chunk; consecutive parts of a chunk are counted together."""

    def counted(chunk: int, found: list[tuple[np.ndarray, ...]]):
        grams, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        both = [np.bincount(where, np.concatenate([f[i] for f in found])).astype(np.int64) for i in (1, 2)]
        for at in range(0, len(grams), 1 << 16):
            some = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(grams[some]), chunk)), *map(pa.array, (grams[some], both[0][some], both[1][some]))],
                names=["chunk", "gram", "background", "target"])

    @lean
    def run(batches):
        chunk, found = None, []
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(cuts, cuts[1:]):
                for part in slices(batch.slice(start, end - start)):
                    if not part.num_rows:
                        continue
                    if found and chunk != numbers[start]:
                        yield from counted(chunk, found)
                        found = []
                    chunk = int(numbers[start])
                    symbols, counts = _symbols(part, known)
                    wanted = np.repeat(part.column("target").to_numpy(zero_copy_only=False).astype(bool), counts)
                    grams, where = np.unique(keys(symbols, counts), return_inverse=True)
                    found.append((grams, np.bincount(where, minlength=len(grams)), np.bincount(where[wanted], minlength=len(grams))))
        if found:
            yield from counted(chunk, found)

    return run


def losses(counts: np.ndarray, size: int) -> np.ndarray:
    """Negative natural log-probability of every trigram of a few symbols: Witten-Bell interpolation of trigrams, bigrams and
    characters. The dense form of ``model``."""
    cube = counts.reshape(size, size, size)
    pairs = cube.sum(axis=0)
    single = pairs.sum(axis=0)
    p = (single + 1) / (single.sum() + size)
    for level in (pairs, cube):
        seen = (level > 0).sum(axis=-1, keepdims=True)
        total = level.sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (level + seen * p) / np.maximum(total + seen, 1), p)
    return -np.log(p).astype(np.float32).ravel()


def model(grams: DataFrame, work: Workspace, characters: int | None = None) -> DataFrame:
    """(gram, target_loss, background_loss) of all trigrams of ``grams`` (gram, background, target; one row each).

    Shorter grams are grouped from longer ones, contexts from the grams that continue them; every level is joined to the level below.
    ``characters`` is the number of symbols of the texts; by default those that occur. A start mark and one unseen symbol are added.
    """
    names, low = ("background", "target"), (1 << _BITS) - 1
    sums = [F.sum(n).alias(n) for n in names]
    contexts = [c for n in names for c in (F.sum(n).alias(f"{n}_total"), F.sum((F.col(n) > 0).cast("long")).alias(f"{n}_seen"))]
    pairs = work.save(grams.groupBy(F.col("gram").bitwiseAND((1 << 2 * _BITS) - 1).alias("gram")).agg(*sums))
    single = work.save(pairs.groupBy(F.col("gram").bitwiseAND(low).alias("gram")).agg(*sums))
    whole = single.agg(F.count("*").alias("n"), *sums).first()
    size = (whole["n"] if characters is None else characters) + _FIRST
    below = single.select("gram", *(((F.col(n) + 1) / F.lit(float((whole[n] or 0) + size))).alias(f"{n}_p") for n in names))
    for level, shorter in ((pairs, low), (grams, (1 << 2 * _BITS) - 1)):
        level = level.select("*", F.shiftright("gram", _BITS).alias("context"), F.col("gram").bitwiseAND(shorter).alias("shorter"))
        held = level.groupBy("context").agg(*contexts).join(level, "context").join(below.withColumnRenamed("gram", "shorter"), "shorter")
        below = held.select("gram", *(
            F.when(F.col(f"{n}_total") > 0, (F.col(n) + F.col(f"{n}_seen") * F.col(f"{n}_p")) / (F.col(f"{n}_total") + F.col(f"{n}_seen")))
            .otherwise(F.col(f"{n}_p")).alias(f"{n}_p") for n in names))
        below = work.save(below)
    return below.select("gram", *((-F.log(f"{n}_p")).alias(f"{n}_loss") for n in names))


def _score(known: np.ndarray | None):
    def run(docs: pa.Table, rows: pa.Table) -> pa.Table:
        grams = rows.column("gram").to_numpy()
        order = np.argsort(grams)
        grams = grams[order]
        tables = [rows.column(f"{n}_loss").to_numpy()[order] for n in ("target", "background")]
        out = []
        for batch in docs.combine_chunks().to_batches():
            for part in slices(batch):
                symbols, counts = _symbols(part, known)
                at = np.searchsorted(grams, keys(symbols, counts))
                ends = np.cumsum(counts)
                means = []
                for table in tables:
                    total = np.concatenate([np.zeros(1), np.cumsum(table[at], dtype=np.float64)])
                    with np.errstate(invalid="ignore"):
                        means.append((total[ends] - total[ends - counts]) / counts)
                empty = counts == 0
                columns = [pa.array(m, pa.float64(), mask=empty) for m in (*means, means[0] - means[1])]
                out.append(pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), *columns],
                    schema=_RESULT))
        return pa.Table.from_batches(out, _RESULT)

    return run


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64())])


def _frequent(texts: DataFrame, vocabulary: int) -> np.ndarray:
    def count(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch):
                for c, n in zip(*(x.tolist() for x in np.unique(code_points(part.column("text"))[0], return_counts=True))):
                    total[c] = total.get(c, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["c", "n"])

    counted = texts.select("text").mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return np.array([r.c for r in counted.orderBy(F.desc("n"), "c").limit(vocabulary).collect()], np.int64)


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, score.

    Tokens are characters. Both models are trigram models with Witten-Bell interpolation over all characters of all documents; with
    ``vocabulary``, over that many most frequent ones, every other character being one symbol. The background is all of ``docs``,
    the target those whose id is in ``target_ids`` (doc_id). ``score`` is the mean over a document's tokens of the target's loss minus
    the background's, in nats: the lower, the more like the target.

    Trigrams are counted over every whole text in chunks of documents, then by Spark; all that occur are kept, and the models are tables that
    grow with the corpus and are nowhere held whole. A chunk is scored with the rows of the trigrams that occur in it, so a task holds
    no more of the models than its texts need.

    Null and empty texts have no tokens and null losses. Without target documents the target model is uniform. Repeated rows count and
    are scored each; null ids are background. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lm")
    ids = work.save(target_ids.select(F.col("doc_id").cast("long").alias("target_id")).where("target_id is not null").distinct())
    marked = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    known = None if vocabulary is None else _frequent(texts, vocabulary)
    flagged = texts.join(marked, texts["doc_id"] == marked["target_id"], "left").select(
        "doc_id", "text", F.col("target_id").isNotNull().alias("target"))
    names = ["doc_id", "text", "target"]
    cut = work.save(flagged.mapInArrow(_chunks(names), "doc_id long, text string, target boolean, chunk long"))
    found = work.save(cut.select("text", "target", "chunk").mapInArrow(
        _count_trigrams(known), "chunk long, gram long, background long, target long"))
    grams = work.save(found.groupBy("gram").agg(F.sum("background").alias("background"), F.sum("target").alias("target")))
    fitted = model(grams, work, None if known is None else len(known))
    needed = found.select("chunk", "gram").join(fitted, "gram")
    result = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return cut.select("doc_id", "text", "chunk").groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(_score(known), result)
