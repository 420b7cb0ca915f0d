"""Ranks inside a cross-section, exact at any cross-section size.

A cross-section (all symbols of one date) is normally a few thousand rows and one window
per date ranks it. Callers pass the checked bound on the cross-section; beyond
``WINDOW_ROWS``, or without a bound, the ranks come from prefix counts over
range-partitioned slices, so no date has to fit in one task however many of the rows it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

WINDOW_ROWS = 1_000_000


def checked_bound(universe: DataFrame) -> int | None:
    """The universe size when it is small enough for window ranks, else ``None``."""
    size = universe.limit(WINDOW_ROWS + 1).count()
    return size if size <= WINDOW_ROWS else None


def _windowed(bound: int | None) -> bool:
    return bound is not None and bound <= WINDOW_ROWS


def running_total(
    df: DataFrame, keys: list[str], order: list[Column], amount: Column, out: str
) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over the rows up to and including this one.

    ``order`` must be total inside ``keys``. Range partitioning cuts a hot group into
    many slices; slices are summed on their own and shifted by the slices before them. The
    placed rows are written once, since both uses must see the same slices.
    """
    placed = durable(
        df.withColumn("amount_", amount)
        .repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("slice_", F.spark_partition_id()),
        "ranked",
    )
    inside = Window.partitionBy(*keys, "slice_").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*keys).orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        placed.groupBy(*keys, "slice_")
        .agg(F.sum("amount_").alias("total_"))
        .withColumn("shift_", F.coalesce(F.sum("total_").over(earlier), F.lit(0)))
        .drop("total_")
    )
    return (
        placed.withColumn("local_", F.sum("amount_").over(inside))
        .join(shift, [*keys, "slice_"])
        .withColumn(out, F.col("local_") + F.col("shift_"))
        .drop("amount_", "slice_", "local_", "shift_")
    )


def doubled_rank(
    df: DataFrame, keys: list[str], value: str, out: str, bound: int | None = None
) -> DataFrame:
    """Adds ``out``: twice the average rank of ``value``, an exact integer; NULL stays unranked."""
    if _windowed(bound):
        # NULLs sort last, so they never move the rank of a value
        below = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()))
        same = F.count("*").over(Window.partitionBy(*keys, value))
        return df.withColumn(
            out,
            F.when(F.col(value).isNotNull(), 2 * below.cast("bigint") + same - 1),
        )
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("same_"))
    ranked = running_total(counts, keys, [F.col(value).asc()], F.col("same_"), "upto_").select(
        *keys, value, (2 * F.col("upto_") - F.col("same_") + 1).alias(out)
    )
    return df.join(ranked, [*keys, value], "left").select(*df.columns, out)


def ranked_count(
    df: DataFrame, keys: list[str], value: str, out: str, bound: int | None = None
) -> DataFrame:
    """Adds ``out``: how many rows of the group carry a ``value``."""
    if _windowed(bound):
        return df.withColumn(out, F.count(value).over(Window.partitionBy(*keys)))
    return df.join(df.groupBy(*keys).agg(F.count(value).alias(out)), keys)


def average_rank(
    df: DataFrame, keys: list[str], value: str, out: str = "average_rank", bound: int | None = None
) -> DataFrame:
    """Adds ``out``: 1-based rank, ties sharing their mean."""
    return doubled_rank(df, keys, value, out, bound).withColumn(out, F.col(out) / F.lit(2.0))


def ordinal_rank(
    df: DataFrame, keys: list[str], value: str, tiebreak: str, out: str, bound: int | None = None
) -> DataFrame:
    """Adds ``out``: gapless 1..k by ``value`` descending, then ``tiebreak``; NULL stays unranked."""
    order = [F.col(value).desc_nulls_last(), F.col(tiebreak).asc()]
    ranked_row = F.col(value).isNotNull()
    if _windowed(bound):
        position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(out, F.when(ranked_row, position))
    positions = running_total(
        df.where(ranked_row).select(*keys, value, tiebreak), keys, order, F.lit(1), out
    ).select(*keys, tiebreak, F.col(out).cast("int").alias(out))
    return df.join(positions, [*keys, tiebreak], "left").select(*df.columns, out)
