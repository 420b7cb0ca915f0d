"""Research reports and run logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finite_or_null
from . import versions
from .bars import has_files

REPORT_TABLES = [
    "panel_statistics", "forward_returns", "ic_observations",
    "quantile_observations", "quantile_spreads",
]


def _json_safe(df: DataFrame) -> DataFrame:
    """Doubles that JSON cannot carry become null."""
    return df.select(*[
        finite_or_null(name).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ])


def write_report(root: str, run_id: str, tables: dict[str, DataFrame], metadata: DataFrame) -> str:
    """Five CSV tables and the metadata as a run folder that must not exist yet.

    They are written elsewhere and take the run's name when all are there: a report that was cut off, or a second one of that name, leaves nothing under it.
    """
    if sorted(tables) != sorted(REPORT_TABLES):
        raise ValueError(f"a report has exactly the tables {REPORT_TABLES}")
    path = f"{root.rstrip('/')}/{run_id}"
    spark = metadata.sparkSession
    if has_files(spark, path):
        raise FileExistsError(path)
    arriving = f"{root.rstrip('/')}/_arriving/{uuid.uuid4().hex}"
    try:
        for name in REPORT_TABLES:
            tables[name].write.mode("error").option("header", True).csv(f"{arriving}/{name}")
        _json_safe(metadata).write.mode("error").option("ignoreNullFields", "false").json(f"{arriving}/metadata")
        if not versions.take_name(spark, arriving, path):
            raise FileExistsError(path)
    except Exception:
        versions.remove(spark, arriving)
        raise
    return path


def read_report_table(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(f"{path}/{name}")


def append_run_log(records: DataFrame, root: str) -> None:
    _json_safe(records).write.mode("append").option("ignoreNullFields", "false").json(root)
