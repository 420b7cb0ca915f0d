"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and how often their ids are linked in the corpus."""

from __future__ import annotations

import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .tables import Workspace, lean
from .tokenizers import apart_in_words, cut_at, load, neighbours, split_finely
from .words import Lexicon, Words, slices, sums, text_bytes

#: Bytes of text of the documents that are aligned and scored together.
CHUNK = 1 << 20
#: Links that are listed at once; groups with more have their equal ids counted first.
_LINKS, _LARGE = 1 << 20, 256
_HELD = 250_000  # pieces of which a worker keeps the tokens
_AT_ONCE = 1 << 13  # pieces that are encoded at once


class ByteSide:
    """Tokens of a byte-level tokenizers file. Ids of texts come piece by piece; a piece whose tokens do not spell it is one id -1."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        alphabet = byte_alphabet()
        self.labels = [b""] * (max([*vocabulary.values(), *self.tokenizer.get_vocab().values()]) + 1)
        for token, i in vocabulary.items():
            self.labels[i] = bytes(alphabet[c] for c in token if c in alphabet)
        self.sizes = pa.array([len(x) for x in self.labels], pa.int64())
        self.apart = apart_in_words(self.labels)
        self.lexicon = Lexicon(self._encode, _HELD)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        labels, ids, sizes = self.labels, [], []
        for at in range(0, len(pieces), _AT_ONCE):
            some = pieces[at:at + _AT_ONCE]
            found = [
                tokens if b"".join([labels[i] for i in tokens]) == piece else [-1]
                for tokens, piece in zip(self._ids([p.decode("utf-8") for p in some]), some)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def split(self, texts: pa.Array) -> Words:
        return split_finely(texts, self.apart)

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        words = self.split(texts)
        ids, lengths = self.lexicon.gather(self.lexicon.rows(words))
        return ids.astype(np.int64), sums(lengths, words.counts)


class PieceSide(ByteSide):
    """Tokens of a sentencepiece model that puts a space before every text; the texts given begin with that space.

    Texts are cut between characters that no piece holds side by side, as a merge would make such a piece. If no piece holds a line break, a part
    is encoded after one, whose tokens are taken off again: no space is put before it that way. Else texts are encoded whole."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.labels = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.sizes = pa.array([len(x) for x in self.labels], pa.int64())
        self.before = self.model.encode("\n")
        held = neighbours(self.labels)
        self.cuts = len(self.before) == 2 and not (held[10].any() or held[:, 10].any())
        # a character of several bytes is never cut; bytes that stand for themselves hold no neighbours
        self.apart = ~held
        self.apart[:, 0x80:0xC0] = False
        self.lexicon = Lexicon(self._encode, _HELD)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        if self.cuts:
            return [ids[2:] for ids in self.model.encode(["\n" + t for t in texts], num_threads=1)]
        return self.model.encode([t[1:] for t in texts], num_threads=1)

    def split(self, texts: pa.Array) -> Words:
        raw, offsets = text_bytes(texts)
        begins = np.zeros(len(raw), bool)
        if self.cuts:
            begins[1:] = self.apart[raw[:-1], raw[1:]]
        return cut_at(raw, begins, offsets)


def as_lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))


def token_ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """(doc, end, place) of every token of the documents: where its bytes end in its document, and its number among all tokens."""
    doc, size = pc.list_parent_indices(ids), sizes.take(pc.list_flatten(ids))
    total = pc.cumulative_sum(size)
    # the running sum begins anew with each document
    before = np.concatenate([[0], total.to_numpy()])[ids.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pa.array(before).take(doc))
    return pa.table({"doc": doc, "end": end, name: pa.array(np.arange(len(end)))})


def common_groups(a: pa.ListArray, b: pa.ListArray, a_sizes: pa.Array, b_sizes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per group, in order: its document and how many tokens of either side it has. A group ends where tokens of both sides do."""
    ends = token_ends(a, a_sizes, "a").join(token_ends(b, b_sizes, "b"), ["doc", "end"], join_type="inner", use_threads=False)
    order = np.argsort(ends.column("a").to_numpy())
    last_a, last_b = ends.column("a").to_numpy()[order], ends.column("b").to_numpy()[order]
    return ends.column("doc").to_numpy()[order], np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)


def _counted(group: np.ndarray, ids: np.ndarray, name: str, large: np.ndarray) -> pa.Table:
    """(group, id, n): every token of a group by itself, but equal ids of large groups counted."""
    whole = pa.table({"group": group, name: ids})
    big = pa.array(large[group])
    some = whole.filter(pc.invert(big))
    some = some.append_column(f"n_{name}", pa.array(np.ones(some.num_rows, np.int64)))
    if not large.any():
        return some
    held = whole.filter(big).group_by(["group", name], use_threads=False).aggregate([([], "count_all")])
    held = held.select(["group", name, "count_all"]).rename_columns(["group", name, f"n_{name}"])
    return pa.concat_tables([some, held.cast(some.schema)]).sort_by("group")


def links(a: np.ndarray, b: np.ndarray, doc: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, width: int):
    """Tables (doc, pair, n) of the links of all groups; a pair is the A id times ``width`` plus the B id. Links of a group are all pairs of its
    tokens of either side. No table has many more than a million rows."""
    alone = (in_a == 1) & (in_b == 1)
    at_a, at_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
    yield pa.table({"doc": doc[alone], "pair": a[at_a[alone]] * width + b[at_b[alone]], "n": np.ones(int(alone.sum()), np.int64)})
    group_a, group_b = np.repeat(np.arange(len(doc)), in_a), np.repeat(np.arange(len(doc)), in_b)
    many_a, many_b, large = ~alone[group_a], ~alone[group_b], in_a * in_b > _LARGE
    left = _counted(group_a[many_a], a[many_a], "a", large)
    right = _counted(group_b[many_b], b[many_b], "b", large)
    groups = left.column("group").to_numpy()
    rows = np.cumsum(np.bincount(right.column("group").to_numpy(), minlength=len(doc))[groups])
    start = 0
    while start < left.num_rows:
        done = rows[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(rows, done + _LINKS, "right")))
        some = left.slice(start, stop - start)
        held = right
        if start or stop < left.num_rows:
            reach = right.column("group").to_numpy()
            low, high = np.searchsorted(reach, groups[start]), np.searchsorted(reach, groups[stop - 1], "right")
            held = right.slice(low, high - low)
        both = some.join(held, "group", join_type="inner", use_threads=False)
        pair = pc.add(pc.multiply(both.column("a"), width), both.column("b"))
        where = pa.array(doc).take(both.column("group"))
        yield pa.table({"doc": where, "pair": pair, "n": pc.multiply(both.column("n_a"), both.column("n_b"))})
        start = stop


def linked_pairs(found) -> pa.Table:
    """(doc, pair, n) with one row for each pair of a document."""
    held = None
    for table in found:
        table = pa.concat_tables([held, table]) if held is not None else table
        held = table.group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).select(["doc", "pair", "n_sum"])
        held = held.rename_columns(["doc", "pair", "n"])
    return held


class Decimals:
    """Decimal digits of ids as rows of bytes."""

    def __init__(self, size: int):
        texts = [str(i).encode() for i in range(size)]
        self.lengths = np.fromiter(map(len, texts), np.int64, size)
        width = int(self.lengths[-1])
        self.digits = np.frombuffer(b"".join(t.ljust(width) for t in texts), np.uint8).reshape(size, width)

    def digests(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, tokens: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; ``tokens`` has its tokens of both sides, '' where there are none."""
        before_a, before_b = np.cumsum(in_a), np.cumsum(in_b)
        place_a = np.arange(len(a)) + np.repeat(before_b - in_b, in_a)
        place_b = np.arange(len(b)) + np.repeat(before_a, in_b)
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[before_a - 1]], mark[place_b[before_b - 1]] = ord("|"), ord(";")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = mark
        starts = ends - lengths - 1
        for d in range(self.digits.shape[1]):
            some = np.flatnonzero(lengths > d)
            out[starts[some] + d] = self.digits[ids[some], d]
        raw = memoryview(out)
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
        return [hashlib.sha256(raw[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(cuts, cuts[1:])]


def _packed(columns: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _align(a_path: str, b_path: str):
    @lean
    def run(batches):
        first, second = ByteSide(a_path), PieceSide(b_path)
        decimals = Decimals(max(len(first.labels), len(second.labels)))
        width = len(second.labels)
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, limit=CHUNK):
                texts = part.column("text")
                empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
                spaced = pc.if_else(pa.array(empty), "", pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), ""))
                (a, n_a), (b, n_b) = first.tokens(spaced), second.tokens(spaced)
                whole = (sums((a < 0).astype(np.int64), n_a) == 0) & (sums((b < 0).astype(np.int64), n_b) == 0)
                a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
                n_a, n_b = np.where(whole, n_a, 0), np.where(whole, n_b, 0)
                doc, in_a, in_b = common_groups(as_lists(a, n_a), as_lists(b, n_b), first.sizes, second.sizes)
                rows = linked_pairs(links(a, b, doc, in_a, in_b, width)).sort_by([("doc", "ascending"), ("pair", "ascending")])
                partial = rows.group_by(["pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
                pairs = partial.column("pair").to_numpy()
                held = np.bincount(rows.column("doc").to_numpy(), minlength=len(n_a))
                index, times = np.searchsorted(pairs, rows.column("pair").to_numpy()), rows.column("n").to_numpy()
                blob = _packed({
                    "doc_id": part.column("doc_id"), "n_a": pa.array(n_a), "n_b": pa.array(n_b),
                    "n_groups": pa.array(np.bincount(doc, minlength=len(n_a))), "n_links": pa.array(sums(times, held)),
                    "groups_sha256": pa.array(decimals.digests(a, b, in_a, in_b, n_a + n_b), pa.string()),
                    "links": as_lists(_small(index), held), "times": as_lists(_small(times), held)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([blob], pa.binary()), pa.array([pairs], pa.list_(pa.int64())),
                     pa.array([partial.column("count_all").to_numpy()], pa.list_(pa.int64()))], names=["chunk", "batch", "pairs", "docs"])
                chunk += 1

    return run


def _score(chunks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one chunk with the corpus-wide counts of its pairs."""
    order = np.argsort(counts.column("pair").to_numpy())
    often = counts.column("docs").to_numpy()[order]
    best = counts.column("best").to_numpy()[order].astype(np.int64)
    out = []
    for blob in chunks.column("batch"):
        with pa.ipc.open_stream(blob.as_buffer()) as reader:
            docs = reader.read_all().combine_chunks()
        index, times = (docs.column(c).combine_chunks() for c in ("links", "times"))
        held = np.diff(index.offsets.to_numpy())
        at, n = index.values.to_numpy(), times.values.to_numpy().astype(np.int64)
        out.append(pa.table([
            *(docs.column(c) for c in _RESULT.names[:5]), pa.array(sums(n * best[at], held)), pa.array(sums(n * often[at], held)),
            docs.column("groups_sha256")], schema=_RESULT))
    return pa.concat_tables(out) if out else _RESULT.empty_table()


_RESULT = pa.schema([
    ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level tokenizers file on a space and the text, B a sentencepiece model on the text, before which it puts that space; neither adds
    tokens, and special strings inside texts are plain text. Places where tokens of both end cut a document into groups; every A and
    B token of a group are linked. ``n_best`` counts the links whose id pair is linked in as many documents, corpus-wide, as any pair of their A
    id; ``count_sum`` adds those numbers of documents over all links. ``groups_sha256`` identifies the groups' ids in order.

    Documents are aligned in chunks of ``CHUNK`` bytes by Arrow: lists are flattened with their parents, sizes summed up within documents, ends
    joined on (document, end), tokens joined on groups, and pairs counted. Spark adds the chunks' counts; a chunk then meets the counts of
    its own pairs only, so nothing held in one place grows with the corpus. A chunk's documents are kept as
    one compressed Arrow batch of their pairs, so texts are encoded once and do not travel.

    Null and empty texts, and texts that the tokens of either side do not spell, have no tokens: zeros and ''. Repeated rows are documents
    of their own; null ids stay null; an empty table gives no rows; other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "alignment")
    width = _width(piece_path)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = work.save(texts.mapInArrow(_align(byte_path, piece_path), "chunk long, batch binary, pairs array<long>, docs array<long>"))
    each = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("chunk", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = work.save(each.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.expr(f"pair div {width}")))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    scored = work.save(counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))
    needed = work.save(chunks.select("chunk", F.explode("pairs").alias("pair"))).join(scored, "pair").select("chunk", "pair", "docs", "best")
    return chunks.select("chunk", "batch").groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(
        _score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _width(piece_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
