"""Forward returns between two exact sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite_or_null, usable_price


def label_sessions(calendar: DataFrame, horizon: int) -> DataFrame:
    """``(as_of_date, end_date)`` for every session that has a session ``horizon`` later."""
    if horizon < 1:
        raise ValueError("a forward return needs a horizon of at least one session")
    return calendar.select(
        F.col("session").alias("as_of_date"),
        F.lead("session", horizon).over(Window.orderBy("session")).alias("end_date"),
    ).where("end_date is not null")


def forward_column(horizon: int) -> Column:
    """Return from this row's ``price`` to the price exactly ``horizon`` sessions later.

    A range frame over the session number finds the end price without joining the bars to
    themselves; a missing session stays NULL.
    """
    ahead = Window.partitionBy("symbol").orderBy("sid").rangeBetween(horizon, horizon)
    end = F.when(F.col("sid").isNotNull(), F.max("price").over(ahead))
    return finite_or_null(F.try_divide(end, F.col("price")) - F.lit(1.0))


def forward_values(bars: DataFrame, calendar: DataFrame, horizon: int) -> DataFrame:
    """``(symbol, as_of_date, forward_return)`` per bar on a session."""
    return (
        bars.join(calendar, F.col("date") == F.col("session"))
        .select("symbol", "session", "sid", usable_price("adjusted_close").alias("price"))
        .select("symbol", F.col("session").alias("as_of_date"), forward_column(horizon).alias("forward_return"))
    )


def forward_returns(
    panel: DataFrame, bars: DataFrame, calendar: DataFrame, horizon: int
) -> DataFrame:
    """Labels for every panel row whose date has an end session; missing prices are unavailable."""
    ends = label_sessions(calendar, horizon)
    values = forward_values(bars, calendar, horizon)
    return (
        panel.join(ends, "as_of_date")
        .join(values, ["as_of_date", "symbol"], "left")
        .select(
            "as_of_date", "end_date", "symbol", "factor_name", "factor_version",
            F.lit(horizon).cast("bigint").alias("horizon_sessions"),
            "forward_return",
            F.col("forward_return").isNotNull().alias("is_available"),
        )
    )


def unlabelled_dates(panel: DataFrame, calendar: DataFrame, horizon: int) -> DataFrame:
    """Panel dates that have no session ``horizon`` later: refused, not shortened."""
    return panel.select("as_of_date").distinct().join(
        label_sessions(calendar, horizon), "as_of_date", "left_anti"
    )
