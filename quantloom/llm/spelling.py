"""Spelling variants: words one edit apart, found by a trie over letter-group counts, and the frequent form each belongs to."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace, lean
from .words import LOWER, Words, slices, text_bytes

#: Letter groups, one level of the trie each: a letter's place in the alphabet (for others, its code) modulo this.
GROUPS = 12
#: Bits of a level's count, which is kept modulo 32: a difference of one stays a difference of one.
_BITS = 5
_COUNT = np.uint64((1 << _BITS) - 1)
_SHIFTS = np.array([_BITS * (GROUPS - 1 - g) for g in range(GROUPS)], np.uint64)
_GROUP_OF = np.array([(c - 97) % GROUPS if 97 <= c <= 122 else c % GROUPS for c in range(256)], np.int64)
#: Words of one part of the trie, and look-ups that one task makes in it.
PART_WORDS, PART_QUERIES = 1 << 15, 1 << 19
_BLOCK = 1 << 18  # rows of a block of the search
_WIDE = 32  # bytes of words compared by arrays; longer ones are compared singly


def _shift_tables(longest: int) -> np.ndarray:
    """What a CRC-32 register of one byte at each of 4 places becomes after 0..longest zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(longest):
        out[n + 1] = (out[n] >> 8) ^ step[out[n] & 255]
    return out


_AFTER = _shift_tables(64)


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of strings put together from a first part of CRC ``first`` and a second one of CRC ``second`` and ``length`` bytes."""
    first, rest = first.astype(np.uint32), length.copy()
    while True:
        step = np.minimum(rest, 64)
        first = np.bitwise_xor.reduce([_AFTER[step, k, (first >> np.uint32(8 * k)) & 255] for k in range(4)])
        rest = rest - step
        if not rest.any():
            return first ^ second


def split_letters(texts: pa.Array, least: int) -> Words:
    """Runs of A-Z, a-z and U+00C0 to U+00FF with ``least`` code points or more, A-Z lower-cased; one byte (Latin-1) a code point."""
    raw, offsets = text_bytes(texts)
    lead = raw == 0xC3  # the letters above 127 are this byte and another
    after = np.zeros(len(raw), bool)
    after[1:] = lead[:-1]
    kept = ~lead
    codes = LOWER[raw]
    codes = np.where(after, codes + np.uint8(0x40), np.where((codes >= 97) & (codes <= 122), codes, 0)).astype(np.uint8)[kept]
    offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    solid = codes > 0
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    borders = offsets[(offsets > 0) & (offsets < len(codes))]
    begins[borders] = solid[borders]
    stops[borders - 1] = solid[borders - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = ends - starts >= least
    return Words(codes, starts[long], ends[long], offsets)


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode("utf-8")


def _count_words(least: int, every: int, held: int = 200_000):
    """(word, n) of the batches' words; about ``held`` words are kept at a time."""

    def table(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    @lean
    def run(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch):
                words = split_letters(part.column("text"), least)
                if not len(words):
                    continue
                _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
                some = words.take(first)
                coded = [_utf8(w) for w in some]
                crc = np.fromiter(map(zlib.crc32, coded), np.uint32, len(coded))
                size = np.fromiter(map(len, coded), np.int64, len(coded))
                ids = part.column("doc_id").to_pylist()
                prefix = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
                hashes = joined_crc(np.repeat(prefix, words.counts), crc[which], size[which])
                struck = (hashes % every == 0) & np.repeat(np.array([i is not None for i in ids]), words.counts)
                often = np.bincount(which[~struck], minlength=len(some))
                for word, n in zip(some, often.tolist()):
                    if n:
                        counts[word] = counts.get(word, 0) + n
                for at in np.flatnonzero(struck).tolist():
                    word = some[which[at]]
                    if len(word) > least:
                        cut = int(hashes[at]) % len(word)
                        word = word[:cut] + word[cut + 1:]
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > held:
                    yield table(counts)
                    counts = {}
        yield table(counts)

    return run


def word_counts(docs: DataFrame, least: int = 5, every: int = 97) -> DataFrame:
    """(word, n): how often each word of ``least`` code points or more occurs in all whole texts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Where ``every`` divides the unsigned CRC-32 h of
    ``<doc_id>:<word>``, the word's code point h modulo its length is left out first; rows without id leave out nothing."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_count_words(least, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[bytes]) -> np.ndarray:
    """Per word its path through the trie: the counts of its letter groups, the first in the highest bits."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    cells = np.repeat(np.arange(len(words)) * GROUPS, lengths) + _GROUP_OF[flat]
    counts = np.bincount(cells, minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype(np.uint64) & _COUNT
    return np.bitwise_or.reduce(counts << _SHIFTS, axis=1) if len(words) else np.zeros(0, np.uint64)


def _changed(keys: np.ndarray, level: int, by: int) -> np.ndarray:
    """The paths with the count of one level changed."""
    shift = _SHIFTS[level]
    count = (keys >> shift) + np.uint64(by % (1 << _BITS)) & _COUNT
    return keys & ~(_COUNT << shift) | count << shift


def reachable(keys: np.ndarray) -> np.ndarray:
    """Per path all paths of words one edit away that the search from it finds: itself, one deficit, or a surplus before a deficit."""
    out = [keys]
    for i in range(GROUPS):
        out.append(_changed(keys, i, -1))
        more = _changed(keys, i, 1)
        out += [_changed(more, j, -1) for j in range(i + 1, GROUPS)]
    return np.stack(out, axis=1)


def _encoded(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _with_path(batches):
    for batch in batches:
        path = vectors(_encoded(batch.column("word"))).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(path)], names=[*batch.schema.names, "path"])


def _queries(low: np.ndarray, high: np.ndarray):
    """(part, word, n) for every part of the trie that a word's search can enter; part k holds the paths low[k]..high[k]."""

    @lean
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                paths = reachable(part.column("path").to_numpy().astype(np.uint64))
                first, last = np.searchsorted(high, paths), np.searchsorted(low, paths, "right") - 1
                found = []
                step = 0
                while True:  # a path may lie in several parts
                    inside = first + step <= last
                    if not inside.any():
                        break
                    word = np.nonzero(inside)[0]
                    found.append(np.unique(word * len(low) + (first + step)[inside]))
                    step += 1
                if found:
                    both = np.unique(np.concatenate(found))
                    word, place = np.divmod(both, len(low))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place, pa.int64()), part.column("word").take(pa.array(word)), part.column("n").take(pa.array(word))],
                        names=["part", "word", "n"])

    return run


class Trie:
    """Words by their paths. A node is a path's beginning; per level the nodes are an ascending array."""

    def __init__(self, paths: np.ndarray):
        order = np.argsort(paths, kind="stable")
        self.members = order
        self.leaves, self.starts = np.unique(paths[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.levels = [np.unique(self.leaves >> s) for s in _SHIFTS[:-1]] + [self.leaves]

    @staticmethod
    def _has(nodes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
        return nodes[at] == wanted

    def search(self, paths: np.ndarray):
        """Pairs (query, member): the members of all leaves that a query's budget of one surplus and one deficit reaches.

        Depth first over blocks of (query, surplus spent): the level below a block is searched before the next block. A deficit ends
        the budget, since a surplus goes first where both are spent (the other word's search finds the rest); one path is left then,
        whose leaf is looked up at once. A surplus that no deficit follows would be a longer word, which finds this one itself."""
        for at in range(0, len(paths), _BLOCK // 4):
            rows = np.arange(at, min(at + _BLOCK // 4, len(paths)))
            stack = [(0, rows, paths[rows], np.zeros(len(rows), bool))]
            while stack:
                level, query, path, spent = stack.pop()
                if len(query) > _BLOCK:
                    half = len(query) // 2
                    stack += [(level, query[half:], path[half:], spent[half:]), (level, query[:half], path[:half], spent[:half])]
                    continue
                if level == GROUPS:
                    yield from self._members(query[~spent], path[~spent])
                    continue
                less = _changed(path, level, -1)
                yield from self._members(query, less)
                more = _changed(path[~spent], level, 1)
                query, path = np.concatenate([query, query[~spent]]), np.concatenate([path, more])
                spent = np.concatenate([spent, np.ones(len(more), bool)])
                alive = self._has(self.levels[level], path >> _SHIFTS[level])
                if alive.any():
                    stack.append((level + 1, query[alive], path[alive], spent[alive]))

    def _members(self, query: np.ndarray, path: np.ndarray):
        at = np.minimum(np.searchsorted(self.leaves, path), len(self.leaves) - 1)
        hit = self.leaves[at] == path
        query, at = query[hit], at[hit]
        sizes = self.ends[at] - self.starts[at]
        total = np.cumsum(sizes)
        # leaves with many words are given out in pieces
        for low in range(0, int(total[-1]) if len(total) else 0, _BLOCK):
            place = np.arange(low, min(low + _BLOCK, int(total[-1])))
            row = np.searchsorted(total, place, "right")
            yield query[row], self.members[self.starts[at[row]] + place - (total[row] - sizes[row])]


class Spelled:
    """Words as arrays: padded at the right and at the left, first and last two bytes."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        short = [w if len(w) <= _WIDE else b"" for w in words]
        self.left = np.frombuffer(b"".join(w.ljust(_WIDE, b"\0") for w in short), np.uint8).reshape(-1, _WIDE)
        self.right = np.frombuffer(b"".join(w.rjust(_WIDE, b"\0") for w in short), np.uint8).reshape(-1, _WIDE)
        self.head = np.frombuffer(b"".join(w[:2] for w in words), np.uint16)
        self.tail = np.frombuffer(b"".join(w[-2:] for w in words), np.uint16)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced byte turns ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1:] == b[at + (len(a) == len(b)):]


def near_pairs(first: Spelled, second: Spelled, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i of first, j of second), the second as long or one shorter, are one edit apart."""
    gap = first.lengths[i] - second.lengths[j]
    out = np.zeros(len(i), bool)
    # an edit leaves the first two or the last two letters alone
    likely = np.flatnonzero(((first.head[i] == second.head[j]) | (first.tail[i] == second.tail[j])) & ((gap == 0) | (gap == 1)))
    wide = np.maximum(first.lengths[i[likely]], second.lengths[j[likely]]) > _WIDE
    for k in likely[wide].tolist():
        out[k] = one_edit(first.words[i[k]], second.words[j[k]])
    likely = likely[~wide]
    a, b, short = i[likely], j[likely], second.lengths[j[likely]]
    differs = first.left[a] != second.left[b]
    prefix = np.minimum(np.argmax(differs, axis=1), short)
    prefix[~differs.any(axis=1)] = 0  # the same word
    back = (first.right[a] != second.right[b])[:, ::-1]
    suffix = np.minimum(np.argmax(back, axis=1), short)
    out[likely] = np.where(gap[likely] == 0, differs.sum(axis=1) == 1, prefix + suffix >= short)
    return out


def _search(queries: pa.Table, members: pa.Table) -> pa.Table:
    """Per word of either side: near words found here, and the best of them (largest n, then first in order)."""
    empty = pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())], names=["word", "n_near", "best_n", "best"])
    if not queries.num_rows or not members.num_rows:
        return empty
    asked, held = _encoded(queries.column("word")), _encoded(members.column("word"))
    first, second = Spelled(asked), Spelled(held)
    paths, member_paths = vectors(asked), vectors(held)
    often = np.concatenate([queries.column("n").to_numpy(), members.column("n").to_numpy()])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j in Trie(member_paths).search(paths):
        near = near_pairs(first, second, i, j)
        i, j = i[near], j[near]
        if len(i):
            # words of one path find each other twice
            same = paths[i] == member_paths[j]
            once = np.ones(len(i), bool)
            once[same] = [asked[x] < held[y] for x, y in zip(i[same].tolist(), j[same].tolist())]
            found.append((i[once], j[once] + len(asked)))
    if not found:
        return empty
    words = asked + held
    a, b = (np.concatenate(x) for x in zip(*found))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    used = np.unique(b)
    names = sorted(range(len(used)), key=lambda k: words[used[k]])
    place = np.empty(len(words), np.int64)
    place[used[names]] = np.arange(len(used))
    order = np.lexsort((place[b], -often[b], a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    text = lambda ids: pa.array([words[k].decode("latin-1") for k in ids.tolist()], pa.string())
    return pa.table([text(a[starts]), pa.array(np.diff(np.append(starts, len(a)))), pa.array(often[b[starts]]), text(b[starts])], names=empty.column_names)


def near_words(work: Workspace, words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have a near one.

    The trie is cut at its words' order into parts of about equal size; a part's first and last path, one row a part, is all that every task
    gets of it. A word looks in the parts that its budget can reach, and the look-ups of a part are dealt to as many
    tasks as their number asks for, each with its own copy of that part."""
    spark = words.sparkSession
    size = words.count()
    parts = max(1, -(-size // PART_WORDS))
    pathed = words.mapInArrow(_with_path, "word string, n long, path long")
    trie = work.save(pathed.repartitionByRange(parts, "path", "word").withColumn("part", F.spark_partition_id().cast("long")))
    bounds = trie.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high")).orderBy("part").toArrow()
    numbers, low, high = (bounds.column(c).to_numpy() for c in ("part", "low", "high"))
    asked = work.save(trie.select("word", "n", "path").mapInArrow(_queries(low.astype(np.uint64), high.astype(np.uint64)), "part long, word string, n long"))
    chunks = asked.groupBy("part").agg(F.ceil(F.count("*") / PART_QUERIES).cast("long").alias("chunks"))
    # parts are numbered here by their order among those that have words
    names = spark.createDataFrame([(k, int(p)) for k, p in enumerate(numbers)], "part long, number long")
    chunks = F.broadcast(work.save(chunks.join(F.broadcast(names), "part")))
    left = asked.join(chunks, "part").select("part", F.pmod(F.xxhash64("word"), F.col("chunks")).alias("chunk"), "word", "n")
    right = trie.select(F.col("part").alias("number"), "word", "n").join(chunks, "number").select(
        "part", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), "word", "n")
    found = left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInArrow(
        _search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(work: Workspace, forms: DataFrame) -> DataFrame:
    """(word, root) of the rows of ``forms`` (word, form): the last word that forms lead to. A form occurs twice as often as its word at least, so
    chains are short and have an end; each round follows two stretches at once."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        known = work.save(known)
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if known.join(ahead, "root", "left_semi").isEmpty():
            return known
        known = known.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, least: int = 5, times: int = 3, every: int = 97, ratio: int = 2) -> DataFrame:
    """One row per word of ``least`` code points or more that occurs ``times`` times or more: word, form, root, n, n_near, form_n.

    Words and n are those of :func:`word_counts`, over all whole texts. Near words differ by one inserted, deleted or replaced code
    point. ``form`` is the near word of largest n (ties: the smallest in code-point order) if that is ``ratio`` times the word's n
    or more, else null, and ``form_n`` its n; ``root`` follows forms to the last word and is the word itself without form; ``n_near`` counts near words.

    Near words are found by a trie of letter-group counts, in which an edit is a surplus of one, a deficit of one or both; every leaf's words
    are compared. Null and empty texts and an empty table give no words; repeated rows count each; other columns are ignored.
    Words travel, texts do not.
    """
    if least < 4:
        raise ValueError("words of fewer than four letters are not told apart by their ends")
    work = Workspace(docs.sparkSession, "spelling")
    words = work.save(word_counts(docs, least, every).where(F.col("n") >= times))
    near = near_words(work, words)
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    known = work.save(words.join(near, "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form.isNotNull(), F.col("best_n")).alias("form_n")))
    last = roots(work, known.where("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
