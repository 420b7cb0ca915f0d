"""Merkle fixity audit of WARC replicas: compare roots, descend only where they differ, name the damaged records."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import Workspace, lean

_GAP = "\r\n\r\n"
#: Where the offsets of a segment's next file begin; no file is as long.
PART = 1 << 31
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)
_ID = re.compile(rb"\r\nwarc-record-id:[ \t]*([^\r\n]*)", re.IGNORECASE)
_URI = re.compile(rb"\r\nwarc-target-uri:[ \t]*([^\r\n]*)", re.IGNORECASE)


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC/1.1 resource record without the blank lines that end it; null url and html are empty."""
    body = F.coalesce(html, F.lit(""))
    key = F.md5(F.coalesce(page_id.cast("string"), F.lit("")))
    uuid = F.concat_ws("-", *(F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(">\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.translate(F.coalesce(url, F.lit("")), "\r\n", ""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(_GAP), body)


def write_warc(
    pages: DataFrame, path: str | dict[str, Callable[[DataFrame, Column], DataFrame]], per_segment: int = 1024, file_bytes: int = 64 << 20,
    compress: bool = False,
) -> None:
    """WARC files of (page_id, url, html), one folder ``segment=n`` per ``per_segment`` consecutive ids, ordered by id;
    pages without id are segment -1. With ``compress`` a file is one gzip stream, and offsets are those of what it holds.

    ``path`` may name several replicas below one folder, as ``folder/name``, each with a function that gives
    (pages, which of them are of this replica) what becomes of them: the pages move once for all of them.

    A segment of more than ``file_bytes``, which many pages without id or with one id make, is dealt by the hash of its rows to
    parts of about half as many bytes, each a file in a folder of its own, ``segment=n_part`` after the first. Equal rows are dealt by
    their number, so no file grows with them, and equal pages always give equal files.
    """
    segment = F.coalesce(F.floor(F.col("page_id") / per_segment), F.lit(-1)).cast("long")
    rows = pages.select(segment.alias("segment"), "page_id", "url", "html")
    bytes_ = F.octet_length(record(F.col("page_id"), F.col("url"), F.col("html"))).cast("long") + len(_GAP)
    sizes = rows.groupBy("segment").agg(F.sum(bytes_).alias("bytes")).where(F.col("bytes") > file_bytes)
    # as few as the bytes allow, so every task can have the list
    large = {r["segment"]: -(-2 * r["bytes"] // file_bytes) for r in sizes.collect()}
    rows = rows.withColumn("part", F.lit(0).cast("long"))
    if large:
        parts = F.broadcast(pages.sparkSession.createDataFrame(list(large.items()), "segment long, parts long"))
        hot = rows.drop("part").join(parts, "segment")
        key = ["segment", "parts", "page_id", "url", "html"]
        digest = F.sha2(F.concat_ws("\n", *(F.coalesce(F.hex(c), F.lit("-")) for c in (F.col("page_id"), F.col("url"), F.col("html")))), 256)
        copies = hot.groupBy("segment", "parts", digest.alias("digest")).agg(F.count("*").alias("n"), F.first(F.struct(*key[2:])).alias("page"))
        # copies are numbered in two steps, a block of numbers and the numbers of a block, each dealt out before it grows
        blocks = copies.withColumn("block", F.explode(F.expr("sequence(0L, (n - 1) div 64)")))
        blocks = blocks.repartition("digest", "block")
        each = blocks.withColumn("copy", F.explode(F.expr("sequence(block * 64, least(block * 64 + 63, n - 1))")))
        dealt = each.select("segment", "page.*", F.pmod(F.xxhash64("digest", "copy"), F.col("parts")).alias("part"))
        rows = rows.join(parts.select("segment"), "segment", "left_anti").unionByName(dealt)
    folder = F.when(F.col("part") == 0, F.col("segment").cast("string")).otherwise(F.concat_ws("_", "segment", "part"))
    rows = rows.select(folder.alias("segment"), "page_id", "url", "html")
    rows = rows.repartition("segment")
    order = ["segment", "page_id", "url", "html"]
    value = record(F.col("page_id"), F.col("url"), F.col("html")).alias("value")
    options = {"lineSep": _GAP, "compression": "gzip" if compress else "none"}
    if isinstance(path, str):
        rows.sortWithinPartitions(*order).select("segment", value).write.partitionBy("segment").options(**options).text(path)
        return
    folder, names = {p.rpartition("/")[0] for p in path}, [p.rpartition("/")[2] for p in path]
    if len(folder) != 1:
        raise ValueError("replicas that are written together lie in one folder")
    # every task makes each replica of its own segments
    each = rows.withColumn("replica", F.explode(F.array(*map(F.lit, names))))
    # one plan for all replicas, each changing its own rows: a union of them would move the pages once for each
    whole = each
    for name, change in zip(names, path.values()):
        whole = change(whole, F.col("replica") == name)
    whole.sortWithinPartitions("replica", *order).select("replica", "segment", value).write.partitionBy("replica", "segment").options(**options).text(
        folder.pop())


def unpacked(content: bytes) -> bytes:
    """What a file holds, with or without gzip; of a damaged gzip stream, what can be read of it."""
    if not content.startswith(b"\x1f\x8b"):
        return content
    out = []
    while content:
        stream = zlib.decompressobj(31)
        try:
            out.append(stream.decompress(content))
        except zlib.error:
            break
        content = stream.unused_data
    return b"".join(out)


def parse(content: bytes):
    """(offset, length, record id, uri, SHA-256) of each record; bytes that are no record to the end of the file are one with null id and uri."""
    at = 0
    while at < len(content):
        head = content.find(b"\r\n\r\n", at)
        size = _LENGTH.search(content, at, head + 2) if head >= 0 and content.startswith(b"WARC/", at) else None
        end = head + 4 + int(size[1]) + 4 if size else len(content)
        if not size or end > len(content):
            yield at, len(content) - at, None, None, hashlib.sha256(content[at:]).hexdigest()
            return
        id_, uri = (x.search(content, at, head + 2) for x in (_ID, _URI))
        text = [m[1].decode("utf-8", "replace") if m else None for m in (id_, uri)]
        yield at, end - at, *text, hashlib.sha256(content[at:end]).hexdigest()
        at = end


@lean
def _records(batches):
    names = ["segment", "offset", "length", "record_id", "uri", "digest"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            out: list[list] = [[] for _ in names]
            segment, part = re.search(r"/segment=(-?\d+)(?:_(\d+))?/[^/]*$", path).groups()
            for offset, *found in parse(unpacked(content.as_py())):
                for column, value in zip(out, (int(segment), int(part or 0) * PART + offset, *found)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files below ``path``: segment, offset, length, record_id, uri, digest.

    The offsets of part k of a segment begin at k times ``PART``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(
        _records, "segment long, offset long, length long, record_id string, uri string, digest string")


def ranges(records: DataFrame, span: int) -> DataFrame:
    """The lowest nodes: a hash over the records that start in each ``span`` bytes, in order of their offsets."""
    nodes = records.groupBy("segment", F.floor(F.col("offset") / span).cast("long").alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "digest"))).alias("held"))
    line = F.transform("held", lambda r: F.concat_ws(":", r["offset"], r["length"], r["digest"]))
    return nodes.select("segment", "node", F.sha2(F.concat_ws("\n", line), 256).alias("hash"))


def parents(nodes: DataFrame, fan: int) -> DataFrame:
    """One level up: a hash over the ``fan`` nodes below, with their numbers, in order."""
    up = nodes.groupBy("segment", F.floor(F.col("node") / fan).cast("long").alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("held"))
    line = F.transform("held", lambda r: F.concat_ws(":", r["node"], r["hash"]))
    return up.select("segment", F.col("up").alias("node"), F.sha2(F.concat_ws("\n", line), 256).alias("hash"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.select("segment", "node", F.col("hash").alias("ha")).join(
        b.select("segment", "node", F.col("hash").alias("hb")), ["segment", "node"], "full")
    return both.where("not (ha <=> hb)").select("segment", "node")


def audit(spark: SparkSession, first: str, second: str, span: int = 1 << 16, fan: int = 16) -> DataFrame:
    """The records in which two replicas differ: segment, offset, length, uri, status, first_digest, second_digest.

    Each file becomes a tree: records are hashed, those that start in the same ``span`` bytes are a lowest node, and ``fan``
    neighbouring nodes are a node of the next level, up to one root. Roots are compared first; below, only children of
    nodes that differ are compared, and only records of differing ranges in the end. There a record is known by its id and digest: one that
    only lies at another offset is not reported. The others are matched by id, in the order of their offsets: ``status`` is "changed" where both
    replicas have one, at the first one's offset, "missing" where only the first has it, "extra" where only the second has.

    A node lists at most ``fan`` children, or the records of ``span`` bytes, so no group grows with the file; the parts of a segment
    are one tree. Equal replicas and empty ones give no rows; a file that only one replica has is reported record by record; a damaged header turns the
    rest of its file into one record with null uri, which is extra while the records it stood for are missing.
    """
    work = Workspace(spark, "warc")
    records = [work.save(manifest(spark, path)) for path in (first, second)]
    levels = [[work.save(ranges(r, span)) for r in records]]
    top = max(r.agg(F.max("node").alias("m")).first().m or 0 for r in levels[0])
    while top > 0:
        levels.append([work.save(parents(nodes, fan)) for nodes in levels[-1]])
        top //= fan
    bad = work.save(_differing(*levels.pop()))
    while levels:
        below = []
        for nodes in levels.pop():
            up = nodes.withColumn("up", F.floor(F.col("node") / fan).cast("long"))
            held = bad.select("segment", F.col("node").alias("up"))
            below.append(up.join(held, ["segment", "up"], "left_semi"))
        bad = work.save(_differing(*below))
    placed = [r.withColumn("node", F.floor(F.col("offset") / span).cast("long")).join(bad, ["segment", "node"], "left_semi").drop("node") for r in records]
    return _unmatched(work, *placed)


def _unmatched(work: Workspace, first: DataFrame, second: DataFrame) -> DataFrame:
    """What is left of the records of differing ranges when those of one id and digest have been taken off both sides."""
    same = ["segment", "record_id", "digest"]
    sides = first.withColumn("side", F.lit(0)).unionByName(second.withColumn("side", F.lit(1)))
    counts = sides.groupBy(*same).agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    counts = counts.where("n0 <> n1").withColumns({f"{c}_": F.col(c) for c in same}).select(*(f"{c}_" for c in same), "n0", "n1")
    near = (F.col("segment") == F.col("segment_")) & F.col("record_id").eqNullSafe(F.col("record_id_")) & (F.col("digest") == F.col("digest_"))
    # of equal records that one side has more often, the last ones are left; files are bounded, so a part's copies are ordered together
    part = F.floor(F.col("offset") / PART)
    left = sides.join(counts, near).withColumn("nth", F.row_number().over(Window.partitionBy("side", *same).orderBy("offset")))
    left = work.save(left.where(F.col("nth") > F.least("n0", "n1")).select("side", "segment", "offset", "length", "record_id", "uri", "digest", part.alias("part")))
    turn = F.row_number().over(Window.partitionBy("side", "segment", "part", "record_id").orderBy("offset"))
    turns = left.withColumn("turn", F.when(F.col("record_id").isNotNull(), turn))
    columns = ["offset", "length", "uri", "digest"]
    a, b = (turns.where(F.col("side") == k).select("segment", "part", "record_id", "turn", *(F.col(c).alias(f"{name}_{c}") for c in columns))
            for k, name in ((0, "first"), (1, "second")))
    both = a.join(b, ["segment", "part", "record_id", "turn"], "full")
    status = F.when(F.col("second_digest").isNull(), "missing").when(F.col("first_digest").isNull(), "extra").otherwise("changed")
    return both.select(
        "segment", *(F.coalesce(f"first_{c}", f"second_{c}").alias(c) for c in columns[:3]), status.alias("status"), "first_digest", "second_digest")


def damaged(pages: DataFrame, only: Column | None = None, per_segment: int = 1024, every: int = 50, hit: int = 7) -> DataFrame:
    """What a damaged replica of ``pages``, or of those of them that ``only`` names, holds: where page_id modulo ``every`` is ``hit`` the middle character of html is overwritten,
    and the page that ends a full segment of ``per_segment`` ids is lost."""
    middle = (F.length("html") / 2).cast("int") + 1
    mark = F.when(F.substring("html", middle, F.lit(1)) == "#", "*").otherwise("#")
    only = F.lit(True) if only is None else only
    struck = only & (F.col("page_id") % every == hit) & (F.length("html") > 0)
    html = F.when(struck, F.overlay("html", mark, middle, F.lit(1))).otherwise(F.col("html"))
    kept = ~only | F.coalesce(F.col("page_id") % per_segment != per_segment - 1, F.lit(True))
    return pages.where(kept).withColumn("html", html)
