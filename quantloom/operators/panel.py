"""Factor panels: one row per date and universe symbol, computed or not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite_or_null, is_finite, moments_of, usable_price
from ..schemas import MOMENTUM_LOOKBACK, MOMENTUM_NAME, MOMENTUM_SKIP, MOMENTUM_VERSION
from .bars import by_symbol

# (bars, dates, universe, calendar) -> panel of all dates
Factor = Callable[[DataFrame, DataFrame, DataFrame, DataFrame], DataFrame]
PANEL_KEY = ["as_of_date", "factor_name", "factor_version"]


def dense_grid(universe: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per ``(as_of_date, symbol)``.

    The result is what the contract asks for; it is generated by exploding date numbers
    per symbol, which keeps the symbols' partitioning and needs no product join.
    """
    numbered = dates.select("as_of_date").distinct().withColumn(
        "n", F.row_number().over(Window.orderBy("as_of_date"))
    )
    size = numbered.agg(F.max("n")).scalar()
    return (
        universe.select("symbol", "ord", F.explode(F.sequence(F.lit(1), size)).alias("n"))
        .join(numbered, "n")
        .select("as_of_date", "symbol", "ord")
    )


def dense_panel(grid: DataFrame, values: DataFrame, name: str, version: str) -> DataFrame:
    """Values laid over the grid; a symbol without a value is present and ineligible."""
    eligible = F.coalesce("is_eligible", F.lit(False))
    return grid.join(values, ["as_of_date", "symbol"], "left").select(
        "as_of_date", "symbol", "ord",
        F.lit(name).alias("factor_name"),
        F.lit(version).alias("factor_version"),
        F.when(eligible, F.col("raw_value")).alias("raw_value"),
        eligible.alias("is_eligible"),
    )


def timed_prices(bars: DataFrame, calendar: DataFrame, lookback: int) -> DataFrame:
    """Usable adjusted closes with their session number and the start of their look-back window."""
    sessions = calendar.select(
        F.col("session").alias("date"), "sid",
        F.lag("session", lookback).over(Window.orderBy("session")).alias("window_start"),
    )
    return bars.join(sessions, "date", "left").select(
        "symbol", "date", "sid", "window_start", usable_price("adjusted_close").alias("price")
    )


def momentum_columns(lookback: int, skip: int) -> tuple[Column, Column]:
    """Value and completeness of one row of :func:`timed_prices`."""
    line = by_symbol()
    far, near = F.lag("price", lookback).over(line), F.lag("price", skip).over(line)
    complete = F.lag("date", lookback).over(line) >= F.col("window_start")
    return finite_or_null(F.try_divide(near, far) - F.lit(1.0)), F.coalesce(complete, F.lit(False))


def momentum_values(
    bars: DataFrame, calendar: DataFrame,
    lookback: int = MOMENTUM_LOOKBACK, skip: int = MOMENTUM_SKIP,
) -> DataFrame:
    """``p[t-skip] / p[t-lookback] - 1`` per bar, with its eligibility.

    Eligible when the window of ``lookback`` sessions before the date holds a bar for every
    session and both prices are usable. Rows are counted, not days: one window over the
    bars of a symbol, at most one row per session.
    """
    value, complete = momentum_columns(lookback, skip)
    rows = timed_prices(bars, calendar, lookback).select(
        "symbol", F.col("date").alias("as_of_date"), value.alias("raw_value"), complete.alias("complete")
    )
    return rows.select(
        "symbol", "as_of_date", "raw_value",
        (F.col("complete") & F.col("raw_value").isNotNull()).alias("is_eligible"),
    )


def momentum(lookback: int = MOMENTUM_LOOKBACK, skip: int = MOMENTUM_SKIP) -> Factor:
    def compute(bars, dates, universe, calendar):
        values = momentum_values(bars, calendar, lookback, skip)
        return dense_panel(dense_grid(universe, dates), values, MOMENTUM_NAME, MOMENTUM_VERSION)

    return compute


def pandas_factor(function, name: str, version: str, fields: list[str]) -> Factor:
    """A user's own per-symbol Python rule as a factor.

    ``function(history) -> DataFrame[as_of_date, symbol, raw_value, is_eligible]`` gets the
    bars of one symbol at a time through Arrow; Spark splits the work by symbol.
    """
    schema = "as_of_date date, symbol string, raw_value double, is_eligible boolean"

    def compute(bars, dates, universe, calendar):
        history = bars.join(universe, "symbol", "left_semi").select("date", "symbol", *fields)
        values = history.groupBy("symbol").applyInPandas(function, schema)
        return dense_panel(dense_grid(universe, dates), values, name, version)

    return compute


def panel_statistics(panel: DataFrame) -> DataFrame:
    """Coverage and moments per date; moments over eligible finite values only."""
    value = F.when(F.col("is_eligible"), finite_or_null("raw_value"))
    moments = moments_of(value)
    return panel.groupBy(*PANEL_KEY).agg(
        F.count("*").alias("universe_size"),
        F.count_if("is_eligible").alias("eligible_count"),
        (F.count_if("is_eligible") / F.count("*")).alias("eligible_coverage"),
        F.count(value).alias("valid_count"),
        (F.count("*") - F.count(value)).alias("missing_count"),
        ((F.count("*") - F.count(value)) / F.count("*")).alias("missing_rate"),
        moments["mean"].alias("mean"),
        moments["std"].alias("std"),
        moments["min"].alias("minimum"),
        moments["max"].alias("maximum"),
    )


def statistics_history(panel: DataFrame, name: str, version: str) -> DataFrame:
    """Statistics of one factor version in date order."""
    mine = (F.col("factor_name") == name) & (F.col("factor_version") == version)
    return panel_statistics(panel.where(mine)).orderBy("as_of_date")


def _flags():
    eligible = F.col("is_eligible")
    infinite = F.coalesce(F.abs("raw_value") == F.lit(float("inf")), F.lit(False))
    return {
        "ineligible": ~eligible,
        "eligible_non_finite_value": eligible & ~is_finite("raw_value"),
        "ineligible_infinite_value": ~eligible & infinite,
    }


def panel_quality(panel: DataFrame) -> DataFrame:
    """Issues per date with their severity and the number of affected symbols."""
    flags = _flags()
    counted = panel.groupBy(*PANEL_KEY).agg(
        F.count("*").alias("universe_size"),
        F.count_if("is_eligible").alias("eligible_count"),
        *[F.count_if(cond).alias(code) for code, cond in flags.items()],
    )

    def issue(code, severity, affected):
        return F.struct(
            F.lit(code).alias("code"), F.lit(severity).alias("severity"),
            F.col(affected).alias("affected_count"),
        )

    none_eligible = F.col("eligible_count") == 0
    coverage = F.when(none_eligible, issue("zero_eligible_coverage", "error", "ineligible")).when(
        F.col("eligible_count") < F.col("universe_size"),
        issue("partial_eligible_coverage", "warning", "ineligible"),
    )
    values = [
        F.when(F.col(code) > 0, issue(code, severity, code))
        for code, severity in [
            ("eligible_non_finite_value", "error"), ("ineligible_infinite_value", "warning"),
        ]
    ]
    return counted.select(
        *PANEL_KEY, "universe_size", "eligible_count",
        (F.col("eligible_count") / F.col("universe_size")).alias("eligible_coverage"),
        F.inline(F.array_compact(F.array(coverage, *values))),
    )


def panel_quality_symbols(panel: DataFrame) -> DataFrame:
    """The affected symbols of every issue, one row each instead of one growing list."""
    flags = _flags()
    some = panel.groupBy(*PANEL_KEY).agg(F.max("is_eligible").alias("some_eligible"))
    coverage = F.when(F.col("some_eligible"), "partial_eligible_coverage").otherwise(
        "zero_eligible_coverage"
    )
    codes = F.array(
        F.when(flags["ineligible"], coverage),
        *[
            F.when(flags[code], F.lit(code))
            for code in ("eligible_non_finite_value", "ineligible_infinite_value")
        ],
    )
    return panel.join(some, PANEL_KEY).select(*PANEL_KEY, F.explode(F.array_compact(codes)).alias("code"), "symbol")
