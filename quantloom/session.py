"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "quantloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on (UTC days, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder is invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/quantloom/{label}-{uuid.uuid4().hex}"


def durable(df, label: str):
    """Write ``df`` to the shared folder and read it back.

    Used where two branches must see exactly the same rows, or where a table is
    reused by several jobs: the copy survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
