"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification, components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shingles import Shingler, common
from .tables import Workspace, lean, text_of
from .words import mix, slices

# The two permutations of the universe of 2^32 shingle ids: the same bijection, differently keyed.
_FIRST, _SECOND = np.uint32(0x9E3779B9), np.uint32(0x7F4A7C15)


def permute(x: np.ndarray, key: np.uint32, out: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, chosen by ``key`` (the finalizer of MurmurHash3), written to ``out``."""
    np.bitwise_xor(x, key, out=out)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(out, np.uint32(shift), out=spare)
        np.bitwise_xor(out, spare, out=out)
        if factor:
            np.multiply(out, np.uint32(factor), out=out)
    return out


def signatures(values: np.ndarray, sizes: np.ndarray, length: int, chunk: int = 1 << 15) -> np.ndarray:
    """Circulant MinHash of consecutive sets, none empty: coordinate k is the minimum of the second permutation, shifted
    circularly by k, over the set's ids after the first permutation. Works on ``chunk`` ids at a time, to stay in cache."""
    out = np.empty((len(sizes), length), np.uint32)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        begin = int(ends[first] - sizes[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + chunk, side="right")))
        short = (values[begin:int(ends[last - 1])] >> np.uint64(32)).astype(np.uint32)
        ids, moved, spare = (np.empty_like(short) for _ in range(3))
        permute(short, _FIRST, ids, spare)
        starts = ends[first:last] - sizes[first:last] - begin
        for k in range(length):
            np.subtract(ids, np.uint32(k), out=moved)
            out[first:last, k] = np.minimum.reduceat(permute(moved, _SECOND, moved, spare), starts)
        first = last
    return out


def nibbles(signature: np.ndarray) -> np.ndarray:
    """The low four bits of all coordinates, sixteen to a number, for cheap estimates; the tail is zero in every row."""
    rows, length = signature.shape
    width = -(-length // 16)
    low = np.zeros((rows, width * 16), np.uint64)
    low[:, :length] = signature & np.uint32(15)
    out = np.zeros((rows, width), np.uint64)
    for i in range(16):
        out |= low[:, i::16] << np.uint64(4 * i)
    return out.view(np.int64)


def unlike_at_most(length: int, percent: int) -> int:
    """Differing nibbles that a pair at the threshold exceeds with probability of about 3 in a million (4.5 deviations)."""
    p = (1 - percent / 100) * 15 / 16
    return int(length * p + 4.5 * (length * p * (1 - p)) ** 0.5) + 1


def _differing(a, b, width: int):
    """How many nibbles differ between two arrays of packed nibbles."""
    total = F.lit(0)
    for i in range(width):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    keys = np.empty((len(signature), bands), np.uint64)
    for j in range(bands):
        key = np.full(len(signature), j + 1, np.uint64)
        for c in range(j * rows, (j + 1) * rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, c].astype(np.uint64))
        keys[:, j] = key
    return keys


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("keys", pa.list_(pa.int64())),
                     ("sketch", pa.list_(pa.int64()))])
_SKETCH_SCHEMA = "doc_id long, n_shingles long, set_id binary, keys array<long>, sketch array<long>"


def _sketches(width: int, bands: int, rows: int, length: int):
    @lean
    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            for part in slices(batch):
                values, sizes = shingler.flat(part.column("text"))
                some = np.flatnonzero(sizes)
                signature = signatures(values, sizes[some], length)
                keys = band_keys(signature, bands, rows).view(np.int64)
                sketch = nibbles(signature)
                lists: list = [None] * len(sizes)
                sketches: list = [None] * len(sizes)
                digests: list = [None] * len(sizes)
                ends = np.cumsum(sizes)
                for at, i in enumerate(some.tolist()):
                    lists[i], sketches[i] = keys[at], sketch[at]
                    digests[i] = hashlib.blake2b(values[ends[i] - sizes[i]:ends[i]].tobytes(), digest_size=16).digest()
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(lists, longs), pa.array(sketches, longs)],
                    schema=_SKETCH)

    return run


def _confirm(width: int, percent: int):
    @lean
    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            for part in slices(batch, "text_a"):
                left = shingler.sets(part.column("text_a"))
                right = shingler.sets(part.column("text_b"))
                keep = []
                for x, y in zip(left, right):
                    shared = common(x, y)
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    return run


def near_dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, length: int = 192, stars: int = 2, wide: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |A and B| >= ``percent`` * |A or B| on their full sets of
    ``width``-word shingles; ``component_id`` is the smallest id reachable by links.

    Candidates share a band of the circulant signature (``bands`` bands of ``rows`` of its ``length`` coordinates: a pair at
    the threshold t is missed with probability (1 - t^rows)^bands). Equal sets are one node from the start. A
    bucket never emits all its pairs, and a candidate whose whole signatures differ too much for the threshold is left out before
    any text moves: ``stars`` times its members are compared with one centre, and linked
    nodes merge; then the members outside a bucket's main component are compared with all members of other components: pair by
    pair in buckets of at most ``wide`` members, and in larger ones through their rarest shingles (:func:`_rare_pairs`), which meets only
    sets that could still be similar enough. A node left with more than ``wide`` candidates in one component meets that component in blocks of
    whole sets, which lists no pairs. So no candidate that could still join two components is left out. Every
    link is confirmed on the full sets of the two whole texts.

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat a ``doc_id`` count once per row
    and their texts join that id's component; a row with null ``doc_id`` is linked with nothing, has a null
    component and is kept. An empty table gives no rows; other columns are ignored.
    """
    if length < bands * rows:
        raise ValueError("the signature must be as long as all bands")
    work = Workspace(docs.sparkSession, "near")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sketched = work.save(texts.mapInArrow(_sketches(width, bands, rows, length), _SKETCH_SCHEMA))
    usable = sketched.where("set_id is not null and doc_id is not null")
    # equal sets have equal keys and sizes; the smallest id stands for all, and copies collapse before the shuffle
    nodes = work.save(usable.groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("n"), F.any_value("keys").alias("keys"),
        F.any_value("sketch").alias("sketch")))
    spread = nodes.select("node", "n", "sketch", F.explode("keys").alias("bucket"))
    most = unlike_at_most(length, percent)
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = work.save(spread.join(shared.select("bucket"), "bucket"))

    links = None
    labels = None
    for turn in range(stars + 1):
        if labels is None:
            placed = members.withColumn("comp", F.col("node"))
        else:
            placed = work.save(members.join(labels, "node", "left").select(
                "node", "n", "sketch", "bucket", F.coalesce("component", "node").alias("comp")))
        other = placed.select("bucket", *(F.col(c).alias(f"other_{c}") for c in ("node", "n", "sketch", "comp")))
        similar = (
            (F.col("comp") != F.col("other_comp"))
            & (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent)
            & (_differing(F.col("sketch"), F.col("other_sketch"), -(-length // 16)) <= most)
        )
        sizes = placed.groupBy("bucket", "comp").agg(
            F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.min_by("node", F.xxhash64("node", "bucket", F.lit(turn))).alias("pick"))
        main = sizes.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("comps"), F.min("low").alias("low"),
            F.max_by(F.struct("comp", "pick"), F.struct("size", "comp")).alias("main"), F.sum("size").alias("members")).where("comps > 1")
        if turn < stars:
            # first the smallest id, then in every bucket another member of its main component
            heads = main.select("bucket", (F.col("low") if turn == 0 else F.col("main.pick")).alias("other_node"))
            asked = placed.join(other.join(heads, ["bucket", "other_node"]), "bucket").where(similar)
        else:
            mains = main.select("bucket", F.col("main.comp").alias("main"), "members")
            met = work.save(placed.join(mains, "bucket"))
            asked = met.where((F.col("comp") != F.col("main")) & (F.col("members") <= wide)).join(other, "bucket").where(similar)
        pairs = asked.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))
        if turn == stars:
            crowd = work.save(met.where(F.col("members") > wide).groupBy("node", "comp").agg(F.max(F.col("comp") != F.col("main")).alias("asks")))
            rare = work.save(_rare_pairs(work, crowd, texts, width, percent))
            many = Window.partitionBy("node", "other_comp")
            rare = work.save(rare.withColumn("many", F.count(F.lit(1)).over(many) > wide))
            pairs = pairs.unionByName(rare.where("not many").select(
                F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")))
        found = work.save(_verified(work, pairs.distinct(), texts, width, percent))
        links = found if links is None else links.unionByName(found)
        if turn == stars:
            attached = work.save(rare.where("many").select("node", F.col("other_comp").alias("comp")).distinct())
            if not attached.isEmpty():
                everyone = nodes.select("node").distinct().join(labels, "node").select("node", F.col("component").alias("comp"))
                links = links.unionByName(work.save(_blockwise(work, attached, everyone, texts, width, percent)))
        labels = components(work, links)

    classes = nodes.select("set_id", "node").join(labels, "node", "left").select("set_id", F.coalesce("component", "node").alias("component_id"))
    out = sketched.join(classes, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: Counters for the frequencies of shingles, by the first bits of their hashes, and how many of them travel in one row.
_SLOT_BITS, _SLOT_ROW = 20, 4096
#: Classes of set sizes: each at most 8 % wide, or one size.
_CLASSES = [1]
while _CLASSES[-1] < 1 << 60:
    _CLASSES.append(max(_CLASSES[-1] + 1, _CLASSES[-1] * 27 // 25))


def _rare_pairs(work: Workspace, crowd: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Candidates (node, other_node, other_comp) between nodes that ask and all others of ``crowd`` (node, comp, asks), of other components:
    every pair that is similar enough, and few that are not.

    With its shingles in any order that is common to all sets, rarest first, a set of n shingles that shares at least m with another
    has one of these among its first n - m + 1. So only these become keys, for each class of sizes that the other set may have, as m follows from
    both sizes: sets that share nothing but a passage, or whose own shingles are too many for a link, meet no one. A pair is listed
    where the shingles from there on can still be enough. The order comes from a table of counts of fixed size over all sets of the crowd; a
    shingle that is counted once is in no other set and makes no key."""
    nodes = F.broadcast(crowd) if crowd.count() <= BROADCAST_IDS else crowd
    held = work.save(texts.join(nodes, texts["doc_id"] == nodes["node"]).select("node", "comp", "asks", "text").mapInArrow(
        _sets(width), "node long, comp long, asks boolean, shingles array<long>"))
    counted = held.select("shingles").mapInArrow(_slot_counts, "part int, counts array<int>").groupBy("part").applyInArrow(
        _slot_ranks, "part int, ranks binary")
    ranks = np.zeros(1 << _SLOT_BITS, np.uint8)
    for row in counted.collect():  # a fixed number of rows, 1 MB together
        ranks[row["part"] * _SLOT_ROW:(row["part"] + 1) * _SLOT_ROW] = np.frombuffer(row["ranks"], np.uint8)
    keys = work.save(held.mapInArrow(_rare_keys(ranks, percent), "key long, node long, comp long, asks boolean, n long, rest long"))
    other = keys.select("key", *(F.col(c).alias(f"other_{c}") for c in ("node", "comp", "n", "rest")))
    return keys.where("asks").join(other, "key").where(
        (F.col("comp") != F.col("other_comp"))
        & (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent)
        & (F.least("rest", "other_rest") * (100 + percent) >= (F.col("n") + F.col("other_n")) * percent)
    ).select("node", "other_node", "other_comp").distinct()


def _sets(width: int):
    @lean
    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            for part in slices(batch):
                values, sizes = shingler.flat(part.column("text"))
                ends = pa.array(np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "comp", "asks")), lists], names=["node", "comp", "asks", "shingles"])

    return run


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


@lean
def _slot_counts(batches):
    total = np.zeros(1 << _SLOT_BITS, np.int32)
    for batch in batches:
        slots, n = np.unique(_slots(batch.column("shingles").flatten().to_numpy().view(np.uint64)), return_counts=True)
        total[slots] += n.astype(np.int32)
    if total.any():
        rows = total.reshape(-1, _SLOT_ROW)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows)), pa.int32()), pa.array(list(rows), pa.list_(pa.int32()))], names=["part", "counts"])


def _slot_ranks(group: pa.Table) -> pa.Table:
    """Counts by size, in steps of a sixth of a doubling or one: 0 for none, 1 for exactly one."""
    group = group.combine_chunks()
    total = group.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, _SLOT_ROW).sum(0, dtype=np.int64)
    ranks = np.where(total > 0, 1 + np.minimum(6 * np.log2(np.maximum(total, 1)), 254), 0).astype(np.uint8)
    return pa.table([group.column("part").slice(0, 1), pa.array([ranks.tobytes()], pa.binary())], names=["part", "ranks"])


def _at_least(first: np.ndarray, second: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles sets of the given sizes share at least, if they are similar enough."""
    return -(-percent * (first + second) // (100 + percent))


def _rare_keys(ranks: np.ndarray, percent: int):
    @lean
    def run(batches):
        bounds = np.array(_CLASSES, np.int64)
        classes = lambda n: np.searchsorted(bounds, n, side="right") - 1
        for batch in batches:
            lists = batch.column("shingles")
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            values = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((values, ranks[_slots(values)], owner))
            values, elsewhere = values[order], (ranks[_slots(values)] > 1)[order]
            place = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
            least, most = -(-percent * n // 100), 100 * n // percent
            own, low, high = classes(n), classes(least), classes(most)
            for step in range(int((high - low).max(initial=-1)) + 1):
                theirs = low + step
                first = np.where((theirs <= high) & (n > 0), n - _at_least(n, np.maximum(bounds[theirs], least), percent) + 1, 0)
                at = np.flatnonzero(elsewhere & (place < first[owner]))
                if len(at):
                    of = owner[at]
                    both = (np.minimum(own, theirs) << 10 | np.maximum(own, theirs))[of].astype(np.uint64)
                    taken = pa.array(of)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(values[at] + mix(both)).view(np.int64)), *(batch.column(c).take(taken) for c in ("node", "comp", "asks")),
                         pa.array(n[of]), pa.array(n[of] - place[at])], names=["key", "node", "comp", "asks", "n", "rest"])

    return run


#: Most documents of either side in one block of :func:`_blockwise`.
BLOCK = 512


def _blockwise(work: Workspace, attached: DataFrame, everyone: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between nodes (node, comp) attached to a component and the component's members ``everyone`` (node, comp).

    Both sides of a component are dealt into blocks of about ``BLOCK`` documents; each pair of blocks is one unit that compares full
    sets through a common index of shingles and returns confirmed links only."""
    inner = attached.groupBy("comp").agg(F.count(F.lit(1)).alias("askers"))
    size = everyone.join(inner, "comp").groupBy("comp").agg(F.count(F.lit(1)).alias("members"), F.any_value("askers").alias("askers"))
    size = work.save(size.select(
        "comp", F.ceil(F.col("members") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("askers") / BLOCK).cast("int").alias("columns")))
    hashed = F.xxhash64("node", F.lit("block"))

    def dealt(nodes, asks, own, others):
        """Each node is in one block of its own side and meets every block of the other."""
        return nodes.join(size, "comp").select(
            "node", "comp", F.lit(asks).alias("asks"), F.pmod(hashed, F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(others))

    units = dealt(everyone, False, "rows", "columns").unionByName(dealt(attached, True, "columns", "rows"))
    ids = work.save(attached.select("node").union(everyone.join(inner, "comp", "left_semi").select("node")).distinct())
    paired = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, texts["doc_id"] == ids["node"], "left_semi")
    held = units.join(paired.select(F.col("doc_id").alias("node"), "text"), "node")
    return held.groupBy("comp", "rows", "columns").applyInArrow(_meet(width, percent), "a long, b long")


def _meet(width: int, percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks, node = group.column("asks").to_numpy(zero_copy_only=False), group.column("node").to_numpy()
        values, sizes = Shingler(width).flat(group.column("text").combine_chunks())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        listed = ~asks[owner]
        order = np.argsort(values[listed], kind="stable")
        index, holder = values[listed][order], owner[listed][order]
        ends = np.cumsum(sizes)
        links: list[tuple[int, int]] = []
        for i in np.flatnonzero(asks).tolist():
            mine = values[ends[i] - sizes[i]:ends[i]]
            low, high = np.searchsorted(index, mine, "left"), np.searchsorted(index, mine, "right")
            n = high - low
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            shared = np.bincount(holder[at], minlength=len(sizes))
            close = (shared > 0) & (100 * shared >= percent * (sizes + sizes[i] - shared))
            links += [(min(node[i], node[j]), max(node[i], node[j])) for j in np.flatnonzero(close).tolist() if node[i] != node[j]]
        return pa.table([pa.array([l[k] for l in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


#: Ids of this many documents or fewer are sent to every executor (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _verified(work: Workspace, pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Only the texts of paired documents move."""
    pairs = work.save(pairs)
    ids = work.save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    paired = texts.join(ids, "doc_id", "left_semi")
    right = paired.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = paired.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(width, percent), "a long, b long")
