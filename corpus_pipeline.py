"""From raw documents to packed training sequences: five stages, each one operator of ``quantloom.llm``.

Every stage reads what its predecessor kept (written as Parquet) and returns the columns of ``documents``; the last
returns sequences. Rows are judged on the stage's own input; models learn from it too, never from held-out ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import language_id, toxicity
from quantloom.llm.exact_dedup import IGNORED, exact_dedup
from quantloom.llm.language_id import held_out
from quantloom.llm.near_dedup import near_dedup
from quantloom.llm.packing import pack
from quantloom.llm.tables import Workspace, text_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without letters or unlike every language go."""
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs.where(~held_out()))
    return language_id.identify(docs, model, carry=True).where("not rejected").select("document.*")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text").where(~held_out()).join(labels, "doc_id"))
    return toxicity.score(docs, model, carry=True).where("predicted = 0").select("document.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts. Rows that repeat id and text become one; of a group whose
    longest rows have no id, one of those stays."""
    docs = docs.select(*COLUMNS)
    decided = Workspace(spark, "distinct").save(exact_dedup(docs))
    dropped = decided.where("not kept and doc_id is not null").select("doc_id", "text_sha256")
    sha = F.sha2(F.translate(text_of(), IGNORED, ""), 256)
    repeated = decided.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    plain = docs.where("doc_id is not null")
    if repeated.isEmpty():
        return plain.join(dropped.select("doc_id"), "doc_id", "left_anti").select(*COLUMNS)
    keyed = docs.withColumn("sha", sha)
    ids = repeated.select(F.col("doc_id").alias("again"))
    unique = plain.join(dropped.select("doc_id"), "doc_id", "left_anti").join(
        ids.where("again is not null"), F.col("doc_id") == F.col("again"), "left_anti")
    # ids that occur several times, and rows without id: decided by id and text together, one row of each
    several = keyed.join(ids, F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
    stay = decided.where("kept").select(F.col("doc_id").alias("stays"), F.col("text_sha256").alias("sha")).distinct()
    several = several.join(stay, (several["sha"] == stay["sha"]) & several["doc_id"].eqNullSafe(stay["stays"]), "left_semi")
    longest = several.groupBy("doc_id", "sha").agg(F.max(F.struct(F.length(text_of()).alias("size"), *COLUMNS[1:])).alias("best"))
    return unique.select(*COLUMNS).unionByName(longest.select("doc_id", *(F.col(f"best.{c}").alias(c) for c in COLUMNS[1:])))


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    docs = docs.select(*COLUMNS)
    dropped = near_dedup(docs, width=5, percent=80, bands=32, rows=5).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two lengths, with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language), ("toxicity", clean), ("exact dedup", distinct),
    ("MinHash near-dedup", near_distinct), ("packing", sequences),
]
#: Tokenizing and fitted models have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return kept
        previous, docs = docs, work.save(kept)
        if i:
            work.drop(previous)
    return docs
