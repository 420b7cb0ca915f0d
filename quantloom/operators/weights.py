"""Score-proportional weights under a single-name cap, for all dates at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_positive
from ..schemas import WEIGHT_TOLERANCE


def _check(cash: float, cap: float) -> None:
    if not 0.0 <= cash <= 1.0:
        raise ValueError("cash must be a share between 0 and 1")
    if not 0.0 < cap <= 1.0:
        raise ValueError("the single-name cap must be above 0 and at most 1")


def water_fill(selected: DataFrame, cash: float, cap: float) -> DataFrame:
    """Adds ``weight`` to ``(as_of_date, symbol, ord, score)`` rows of a selection.

    Pinning the largest names at the cap and re-splitting the rest has a closed form: with scores
    in falling order, the first name whose share of what is left fits under the cap ends the
    pinning. The tail sums run over the rising order, where the frame grows one row at a time. A
    selection is bounded by the N of the strategy that made it.
    """
    _check(cash, cap)
    budget, day = 1.0 - cash, Window.partitionBy("as_of_date")
    rising = day.orderBy(F.col("score").asc(), F.col("symbol").desc())
    tail = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.lit(budget) - F.col("above") * F.lit(cap)
    rows = (
        selected.withColumn("names", F.count("*").over(day))
        .withColumn("scaled", F.try_divide("score", F.max("score").over(day)))
        .withColumn("above", F.col("names") - F.row_number().over(rising))
        .withColumn("tail", F.sum("scaled").over(tail))
        .withColumn("fits", F.try_divide(left * F.col("scaled"), F.col("tail")) <= cap)
        .withColumn(
            "pinned",
            F.coalesce(F.min(F.when(F.col("fits"), F.col("above"))).over(day), F.col("names")),
        )
        .withColumn(
            "free_tail",
            F.max(F.when(F.col("above") == F.col("pinned"), F.col("tail"))).over(day),
        )
    )
    rest = F.lit(budget) - F.col("pinned") * F.lit(cap)
    weight = F.when(F.col("above") < F.col("pinned"), F.lit(cap)).otherwise(
        F.try_divide(rest * F.col("scaled"), F.col("free_tail"))
    )
    return rows.select(*selected.columns, weight.alias("weight"))


def weight_refusals(selected: DataFrame, cash: float, cap: float) -> DataFrame:
    """Why a date's selection cannot be weighted: ``(rule, as_of_date, symbol)``."""
    _check(cash, cap)
    bad = ~is_positive("score")
    scores = selected.where(bad).select(F.lit("non_positive_score").alias("rule"), "as_of_date", "symbol")
    short = (
        selected.groupBy("as_of_date")
        .agg(F.count("*").alias("names"))
        .where(F.col("names") * F.lit(cap) + F.lit(WEIGHT_TOLERANCE) < F.lit(1.0 - cash))
        .select(F.lit("infeasible_cap").alias("rule"), "as_of_date", F.lit(None).cast("string").alias("symbol"))
    )
    clean = selected.join(scores.select("as_of_date"), "as_of_date", "left_anti")
    starved = (
        water_fill(clean, cash, cap)
        .where(F.coalesce(F.col("weight") <= 0.0, F.lit(True)))
        .select(F.lit("starved_share").alias("rule"), "as_of_date", "symbol")
    )
    return scores.unionByName(short).unionByName(starved)


def capped_score_weights(selected: DataFrame, cash: float, cap: float) -> DataFrame:
    """Target positions of every date that can be weighted; refused dates have none."""
    refused = weight_refusals(selected, cash, cap).select("as_of_date").distinct()
    allowed = selected.join(refused, "as_of_date", "left_anti")
    return water_fill(allowed, cash, cap)


def target_cash(result: DataFrame, cash: float) -> DataFrame:
    """Cash share per date: the target share, or everything when nothing was selected."""
    return result.groupBy("as_of_date").agg(
        F.when(F.count_if("is_selected") > 0, F.lit(float(cash))).otherwise(F.lit(1.0)).alias("cash_weight")
    )
