"""Exact dedup: one 128-bit content hash per text, byte comparison inside equal hashes. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Workspace, text_of

#: Characters that do not count when texts are compared: ``[\x20\x09-\x0D]``.
IGNORED = " \t\n\x0b\x0c\r"
_TOP = 2**63 - 1  # largest id
_SPAN = 2**65  # room for every id and for "no id"


def md5(text: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(text))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def exact_dedup(
    docs: DataFrame,
    content_hash: Callable[[Column], Column] = md5,
    lookup_digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after deleting ASCII white space. Of equal texts the row with
    the most code points of the original text stays, then the smallest ``doc_id``.

    Candidate groups share the 128-bit hash. Bytes are compared by grouping on (hash, normalised text):
    equal texts collapse inside each task before the shuffle, so a text that holds a third of all rows
    costs one row per task, and every distinct text moves once. Rows then find their group through (hash,
    SHA-256) without moving texts again; digests shared by different texts are looked for, not assumed
    away, and rows that have them find their group by their bytes. The join of rows to groups has no aggregation
    above it, so adaptive execution splits a hot group.

    Null text counts as empty; empty texts are one group. A null ``doc_id`` comes after every id, so
    ``keep_id`` is null only where no row of that length has an id; such a row is kept. Rows that repeat the
    same id and text are the same document: each counts in ``group_size`` and all carry the same ``kept``. An
    empty table gives no rows; other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "exact")
    rows = docs.select("doc_id", F.length(text_of()).alias("size"), F.translate(text_of(), IGNORED, "").alias("norm"))
    # one number that orders by length, then by smallest id, then "no id"
    order = F.coalesce(_whole(_TOP + 1) - F.col("doc_id").cast("decimal(20,0)"), _whole(0))
    rows = rows.select(
        "doc_id", "norm", content_hash(F.col("norm")).alias("hash"), lookup_digest(F.col("norm")).alias("digest"),
        (F.col("size").cast("decimal(10,0)") * _whole(_SPAN) + order).cast("decimal(38,0)").alias("rank"))
    texts = rows.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("best"))
    texts = work.save(texts.select(
        "hash", lookup_digest(F.col("norm")).alias("digest"), sha256(F.col("norm")).alias("text_sha256"), "group_size", "best"))
    groups = texts.groupBy("hash", "digest").agg(
        F.count(F.lit(1)).alias("texts"), F.first("text_sha256").alias("text_sha256"),
        F.first("group_size").alias("group_size"), F.first("best").alias("best"))
    groups = work.save(groups)
    shape = ["doc_id", "text_sha256", "group_size", "best"]
    found = rows.select("doc_id", "hash", "digest").join(groups.where("texts = 1"), ["hash", "digest"]).select(*shape)
    shared = groups.where("texts > 1").select("hash", "digest")
    if not shared.isEmpty():
        own = rows.join(shared, ["hash", "digest"])
        own_groups = own.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("best"))
        found = found.unionByName(
            own.join(own_groups, "norm").select("doc_id", sha256(F.col("norm")).alias("text_sha256"), "group_size", "best"))
    low = F.col("best") % _whole(_SPAN)
    keep = F.when(low != 0, (_whole(_TOP + 1) - low).cast("long"))
    return found.withColumn("keep_id", keep).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")

