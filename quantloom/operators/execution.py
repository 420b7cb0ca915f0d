"""Pricing scheduled orders at the open of their session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import usable_price
from ..schemas import MAX_SLIPPAGE_BPS, SLIPPAGE_BPS


def _priced(orders: DataFrame, opens: DataFrame) -> DataFrame:
    table = opens.select("symbol", F.col("date").alias("scheduled_fill_date"), usable_price("open").alias("open"))
    return orders.join(table, ["symbol", "scheduled_fill_date"], "left")


def unpriced_orders(orders: DataFrame, opens: DataFrame) -> DataFrame:
    """Orders whose session has no usable open; no other price stands in."""
    return _priced(orders, opens).where("open is null").select(*orders.columns)


def fill_orders(
    orders: DataFrame, opens: DataFrame, slippage_bps: float = SLIPPAGE_BPS, commission: float = 0.0
) -> DataFrame:
    """Complete fills: buys above the open, sells below it, a flat cost each.

    Orders without a usable open are left to :func:`unpriced_orders`; :func:`execute_orders` refuses them.
    """
    if not 0.0 <= slippage_bps < MAX_SLIPPAGE_BPS:
        raise ValueError("slippage must be at least 0 and below 10000 basis points")
    if commission < 0:
        raise ValueError("a cost is never negative")
    slip = F.lit(slippage_bps / 10_000.0)
    buy = F.col("side") == "BUY"
    gross, cost = F.col("gross_notional"), F.col("transaction_cost")
    return (
        _priced(orders, opens)
        .where("open is not null")
        .withColumn("fill_date", F.col("scheduled_fill_date"))
        .withColumn("fill_price", F.col("open") * F.when(buy, 1.0 + slip).otherwise(1.0 - slip))
        .withColumn("transaction_cost", F.lit(float(commission)))
        .withColumn("gross_notional", F.col("fill_price") * F.col("quantity"))
        .withColumn("cash_change", F.when(buy, -(gross + cost)).otherwise(gross - cost))
        .select(
            "order_id", "decision_date", "scheduled_fill_date", "symbol", "side", "quantity",
            "fill_date", "fill_price", "transaction_cost", "gross_notional", "cash_change",
        )
    )


def execute_orders(
    orders: DataFrame, opens: DataFrame, slippage_bps: float = SLIPPAGE_BPS, commission: float = 0.0
) -> DataFrame:
    """Fills of all orders; a single order without a usable open stops the run."""
    missing = unpriced_orders(orders, opens).select("order_id").limit(5).collect()
    if missing:
        raise ValueError(f"orders without a usable open: {[r[0] for r in missing]}")
    return fill_orders(orders, opens, slippage_bps, commission)


def order_fills(fills: DataFrame) -> DataFrame:
    return fills.orderBy("fill_date", "order_id")
