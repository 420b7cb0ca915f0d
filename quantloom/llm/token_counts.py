"""Token counts through a digest cache: only contents that no earlier run has counted are encoded."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace, lean, text_of
from .tokenizers import PieceEncoder, version_digest
from .words import slices

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens long"


def content_digest(text=None):
    """128 bits of the normalised content. The tokenizer normalises nothing away, so only null and empty coincide."""
    text = text_of() if text is None else text
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _count(path: str):
    @lean
    def run(batches):
        encoder = PieceEncoder(path)
        for batch in batches:
            for part in slices(batch):
                counts = encoder.lengths(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return run


def read_cache(spark, path: str) -> DataFrame:
    """The cache table, empty where nothing has been written yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Counts are those of the tokenizers file without special tokens added and without truncation. The cache is a
    Parquet table (tokenizer digest, content digest, n_tokens) below ``cache_path``; a new one per call if
    None. Contents that it lacks are encoded once each, however often they occur, and appended;
    then all documents look their counts up. Copies of a text collapse in each task before the one shuffle of
    texts; the lookup moves digests only, and adaptive execution splits a content that holds many rows.
    A digest that two concurrent runs append twice is read once.

    Null text counts as empty (0 bytes, 0 tokens). Repeated rows each give a row; null ids stay null. An empty
    table gives no rows and appends nothing; other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "tokens")
    cache_path = cache_path or work.path()
    version = version_digest(tokenizer_path)
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("content", content_digest(F.col("text")))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version).select("content")
    misses = rows.groupBy("content").agg(F.min("text").alias("text")).join(known, "content", "left_anti")
    fresh = misses.mapInArrow(_count(tokenizer_path), "content binary, n_tokens long")
    fresh.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    # stored, so that the join below has plain exchanges on both sides and a hot content can be split
    counts = work.save(counts.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return sizes.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
