"""Intermediate tables in the shared folder, and columns that survive clashing names."""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.session import scratch_path


#: Bytes of the Arrow batches that tasks exchange with Python, and Spark's own setting, which is replaced.
BATCH_BYTES, _DEFAULT = 8 << 20, 64 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes in this session, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") in (str(_DEFAULT), "-1", str(2**31 - 1)):
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Returns freed memory to the machine: workers and the driver live on after a task, and would hold it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def lean(run):
    """A function over a task's batches that gives its memory back when the task ends."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


class Workspace:
    """Tables of one operator call below the shared folder; ``drop`` removes those no longer needed.

    Every table is written and read back, so a lost executor costs a re-read and never a different answer.
    """

    def __init__(self, spark: SparkSession, label: str):
        small_batches(spark)
        self.spark, self.root, self.count = spark, scratch_path(spark, label), 0

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Deletes the files behind a saved table."""
        for name in df.inputFiles()[:1]:
            _delete(self.spark, name.rsplit("/", 1)[0])

    def clear(self) -> None:
        """Deletes all tables of the call, once its result no longer reads them."""
        _delete(self.spark, self.root)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def text_of(column: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows: those whose id has the smallest hash. Only ids are ordered; whole rows move for the chosen ids alone."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.join(F.broadcast(ids), "doc_id", "left_semi").limit(rows)


def sample_each(docs: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of ``rows`` ids of each ``key``: those with the smallest hash. Hashes up to a share that leaves about twice
    as many are kept first, so that no group is ordered whole."""
    ids = docs.where("doc_id is not null").select(key, "doc_id").distinct()
    sizes = ids.groupBy(key).count().withColumn("share", 2.0 * rows / F.col("count"))
    hashed = ids.withColumn("hash", F.xxhash64("doc_id")).join(F.broadcast(sizes), key)
    few = hashed.where((F.col("hash") / 2.0**64 + 0.5 <= F.col("share")) | (F.col("count") <= 2 * rows))
    place = F.row_number().over(Window.partitionBy(key).orderBy("hash", "doc_id"))
    chosen = few.withColumn("place", place).where(F.col("place") <= rows).select(key, "doc_id")
    return docs.join(F.broadcast(chosen), [key, "doc_id"], "left_semi")


def inputs(docs: DataFrame, carry: bool) -> DataFrame:
    """(doc_id, text), and with ``carry`` the whole row as the struct ``document``, so that no name can clash."""
    small_batches(docs.sparkSession)
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return docs.select(*columns, *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")] if carry else []))


def results(schema: str, given: DataFrame) -> T.StructType:
    """The result columns, and ``document`` where the input carries it."""
    out = T.StructType(list(T.StructType.fromDDL(schema).fields))
    return out.add("document", given.schema["document"].dataType) if "document" in given.columns else out


def emit(part: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """doc_id of ``part``, the given columns, and ``document`` where ``part`` carries it."""
    out = {"doc_id": part.column("doc_id"), **columns}
    if "document" in part.schema.names:
        out["document"] = part.column("document")
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
