"""Checks and summaries of a bar table, each a single pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import NON_NULL_COLUMNS


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with its declared type."""
    spark = df.sparkSession
    return spark.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)],
        "position int, column string, type string",
    )


def duplicate_rows(bars: DataFrame) -> DataFrame:
    """Rows beyond the first of each ``(symbol, date)``."""
    keys = bars.groupBy("symbol", "date").agg(F.count("*").alias("copies"))
    return keys.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _null_count(bars: DataFrame, name: str):
    """-1 marks a column the table does not have."""
    missing = F.lit(-1).cast("bigint")
    return F.count_if(F.col(name).isNull()) if name in bars.columns else missing


def null_counts(bars: DataFrame) -> DataFrame:
    """Nulls of every required column, one row per column, from one scan."""
    entries = [
        F.struct(F.lit(name).alias("column"), _null_count(bars, name).alias("null_count"))
        for name in NON_NULL_COLUMNS
    ]
    return bars.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def year_coverage(bars: DataFrame) -> DataFrame:
    year = F.col("year") if "year" in bars.columns else F.year("date")
    return bars.groupBy(year.alias("year")).agg(F.count("*").alias("row_count"))


def summarize_dataset(bars: DataFrame) -> DataFrame:
    """Row count and date range per ``(symbol, year)``, unknown keys first."""
    symbol = F.col("symbol") if "symbol" in bars.columns else F.lit(None).cast("string")
    year = F.col("year") if "year" in bars.columns else F.year("date")
    return (
        bars.groupBy(symbol.alias("symbol"), year.alias("year"))
        .agg(
            F.count("*").alias("n_rows"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
        .orderBy(F.asc_nulls_first("symbol"), F.asc_nulls_first("year"))
    )


def dataset_stats(bars: DataFrame) -> DataFrame:
    """Per symbol and year: rows, with the symbol's own date range."""
    per_year = bars.groupBy("symbol", F.year("date").alias("year")).agg(
        F.count("*").alias("row_count"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    span = per_year.groupBy("symbol").agg(F.min("lo").alias("min_date"), F.max("hi").alias("max_date"))
    return per_year.join(span, "symbol").select("symbol", "min_date", "max_date", "year", "row_count")


def head_tail_sample(bars: DataFrame, rows: int = 3) -> DataFrame:
    """First and last rows by date (symbol breaking ties); both are top-k, not sorts."""
    head = bars.orderBy("date", "symbol").limit(rows).withColumn("part", F.lit("head"))
    tail = bars.orderBy(F.desc("date"), F.desc("symbol")).limit(rows).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def verify_dataset(bars: DataFrame) -> DataFrame:
    """One verdict row: size, date range, duplicates, nulls and the issues they raise.

    Rows are first counted per key, so duplicates and nulls come out of one shuffle. Without ``symbol`` duplicates are
    not checked; without ``date`` nothing but that is reported.
    """
    dated = "date" in bars.columns
    keyed = dated and "symbol" in bars.columns
    checked = NON_NULL_COLUMNS if dated else []
    present = [name for name in checked if name in bars.columns]
    absent = [name for name in checked if name not in bars.columns]
    keys = [name for name in ("symbol", "date") if name in bars.columns]
    per_key = bars.groupBy(*keys).agg(
        F.count("*").alias("copies"),
        *[F.count_if(F.col(n).isNull()).alias(f"null_{n}") for n in present],
    )
    lo, hi = (F.min("date"), F.max("date")) if dated else (F.lit(None), F.lit(None))
    repeats = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)) if keyed else F.lit(0).cast("bigint")
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        lo.cast("date").alias("min_date"), hi.cast("date").alias("max_date"),
        repeats.alias("duplicate_rows"),
        *[F.coalesce(F.sum(f"null_{n}"), F.lit(0)).alias(f"null_{n}") for n in present],
    )
    empty = F.col("n_rows") == 0
    issues = [
        F.when(empty, F.lit("dataset contains 0 rows")),
        *([] if dated else [F.when(~empty, F.lit("missing column date"))]),
        *([F.when(~empty & F.col("min_date").isNull(), F.lit("date range is empty"))] if dated else []),
        F.when(F.col("duplicate_rows") > 0, F.lit("duplicate (symbol, date) rows")),
        *[F.when(~empty & (F.col(f"null_{n}") > 0), F.lit(f"null values in {n}")) for n in present],
        *[F.when(~empty, F.lit(f"missing column {n}")) for n in absent],
    ]
    found = totals.withColumn("issues", F.array_compact(F.array(*issues)))
    return found.select(
        "n_rows", "min_date", "max_date", "duplicate_rows", "issues",
        (F.size("issues") == 0).alias("ok"),
    )


def status_tally(statuses: DataFrame, column: str = "status") -> DataFrame:
    """Counts per outcome of a batch."""
    return statuses.groupBy(column).agg(F.count("*").alias("row_count"))
