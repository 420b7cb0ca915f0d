"""From the weights held to the weights wanted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import WEIGHT_TOLERANCE

def portfolio_transition(state: DataFrame, target: DataFrame) -> DataFrame:
    """Every symbol of either side: target order first, then names only held.

    Both sides are ``(as_of_date, symbol, ord, weight)``; a missing side is exactly 0.
    """
    key = ["as_of_date", "symbol"]
    t = target.select(*key, F.col("ord").alias("t_ord"), F.col("weight").alias("target"))
    s = state.select(*key, F.col("ord").alias("s_ord"), F.col("weight").alias("current"))
    both = t.join(s, key, "full_outer").select(
        *key,
        F.coalesce("current", F.lit(0.0)).alias("current_weight"),
        F.coalesce("target", F.lit(0.0)).alias("target_weight"),
        F.when(F.col("t_ord").isNull(), 1).otherwise(0).alias("section"),
        F.coalesce("t_ord", "s_ord").alias("side_ord"),
    )
    place = F.row_number().over(Window.partitionBy("as_of_date").orderBy("section", "side_ord", "symbol"))
    return both.select(
        *key, "current_weight", "target_weight",
        (F.col("target_weight") - F.col("current_weight")).alias("weight_change"),
        place.alias("position"),
    )


def transition_status() -> Column:
    change = F.col("weight_change")
    return (
        F.when((F.col("current_weight") == 0) & (F.col("target_weight") > 0), "entry")
        .when((F.col("current_weight") > 0) & (F.col("target_weight") == 0), "exit")
        .when(change > WEIGHT_TOLERANCE, "increase")
        .when(change < -WEIGHT_TOLERANCE, "decrease")
        .otherwise("unchanged")
    )


def transition_totals(
    transition: DataFrame, state_cash: DataFrame, target_cash: DataFrame
) -> DataFrame:
    """Weight bought, weight sold, move of the cash share and one-sided turnover per date."""
    change = F.col("weight_change")
    moved = transition.groupBy("as_of_date").agg(
        F.sum(F.greatest(change, F.lit(0.0))).alias("buy_weight"),
        F.sum(F.greatest(-change, F.lit(0.0))).alias("sell_weight"),
    )
    cash = target_cash.select("as_of_date", F.col("cash_weight").alias("wanted")).join(
        state_cash.select("as_of_date", F.col("cash_weight").alias("held")), "as_of_date"
    )
    zero = F.lit(0.0)
    return (
        cash.join(moved, "as_of_date", "left")
        .select(
            "as_of_date",
            F.coalesce("buy_weight", zero).alias("buy_weight"),
            F.coalesce("sell_weight", zero).alias("sell_weight"),
            (F.col("wanted") - F.col("held")).alias("cash_weight_change"),
        )
        .withColumn(
            "turnover",
            (F.col("buy_weight") + F.col("sell_weight") + F.abs("cash_weight_change")) * F.lit(0.5),
        )
    )


def previous_target(target: DataFrame, cash: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state before each date: the target of the date before, all cash on the first."""
    order = Window.orderBy("as_of_date")
    dates = cash.select("as_of_date", "cash_weight").withColumn(
        "next_date", F.lead("as_of_date").over(order)
    )
    state = target.join(dates.where("next_date is not null"), "as_of_date").select(
        F.col("next_date").alias("as_of_date"), "symbol", "ord", "weight"
    )
    state_cash = dates.select(
        "as_of_date", F.coalesce(F.lag("cash_weight").over(order), F.lit(1.0)).alias("cash_weight")
    )
    return state, state_cash
