"""Keyed upsert of downloaded bars into published ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PRICE_COLUMNS, STANDARD_COLUMNS
from .bars import derive_features

_VALUES = [*PRICE_COLUMNS, "volume"]


def keep_last(rows: DataFrame, order: str) -> DataFrame:
    """One row per ``(symbol, date)``: the one with the highest ``order``.

    An aggregate rather than a ranked window: copies collapse on the map side,
    so a key repeated many times never gathers its copies in one task.
    """
    return rows.groupBy("symbol", "date").agg(
        *[F.max_by(name, order).alias(name) for name in _VALUES]
    )


def _tagged(published: DataFrame, downloaded: DataFrame, arrival: str) -> DataFrame:
    old = published.select("symbol", "date", *_VALUES, F.lit(-1).cast("bigint").alias("arrival"))
    new = downloaded.select("symbol", "date", *_VALUES, F.col(arrival).cast("bigint").alias("arrival"))
    return old.unionByName(new)


def union_windows(downloaded: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Slices of several download windows as one table, the last arrival winning."""
    return keep_last(downloaded, arrival).select("symbol", "date", *_VALUES)


def merge_bars(published: DataFrame, downloaded: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Downloaded rows replace published ones; derived columns cover the whole history again.

    ``arrival`` numbers downloaded rows from 0 in delivery order.
    """
    tagged = _tagged(published, downloaded, arrival)
    merged = keep_last(tagged, "arrival")
    return derive_features(merged).select(*STANDARD_COLUMNS)


def merge_report(published: DataFrame, downloaded: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Per symbol: row counts before and after, new and replaced dates, date range."""
    per_key = (
        _tagged(published, downloaded, arrival)
        .groupBy("symbol", "date")
        .agg(
            F.count_if(F.col("arrival") < 0).alias("old_rows"),
            F.count_if(F.col("arrival") >= 0).alias("new_rows"),
        )
    )
    had, got = F.col("old_rows") > 0, F.col("new_rows") > 0
    return (
        per_key.groupBy("symbol")
        .agg(
            F.sum("old_rows").alias("existing_rows"),
            F.sum("new_rows").alias("downloaded_rows"),
            F.count("*").alias("merged_rows"),
            F.count_if(got & ~had).alias("new_dates"),
            F.count_if(got & had).alias("replaced_dates"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
        .withColumn(
            "retained_rows",
            F.greatest(F.col("existing_rows") - F.col("replaced_dates"), F.lit(0)),
        )
    )


def replaced_dates(published: DataFrame, downloaded: DataFrame) -> DataFrame:
    keys = ["symbol", "date"]
    return downloaded.select(*keys).intersect(published.select(*keys))


def new_dates(published: DataFrame, downloaded: DataFrame) -> DataFrame:
    keys = ["symbol", "date"]
    return downloaded.select(*keys).subtract(published.select(*keys))
