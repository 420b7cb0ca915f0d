"""Strategies: from factor panels to a scored, ranked, selected cross-section."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import finite_or_null
from .ranking import ordinal_rank

TOP_N_NAME, TOP_N_VERSION = "top_n_by_factor", "1.0.0"


def context_panels(panels: DataFrame, requirements: DataFrame) -> DataFrame:
    """Rows of exactly the required ``(factor_name, factor_version)`` panels."""
    return panels.join(requirements, ["factor_name", "factor_version"], "left_semi")


def missing_panels(panels: DataFrame, requirements: DataFrame, dates: DataFrame) -> DataFrame:
    """Requirements without a panel on a date; no other version stands in for them."""
    wanted = dates.select("as_of_date").distinct().select(
        "as_of_date", F.lit(True).alias("wanted")
    )
    have = panels.select("as_of_date", "factor_name", "factor_version").distinct()
    keys = requirements.select("factor_name", "factor_version").distinct()
    # requirements are a handful of declared keys; each date carries them as an array
    declared = keys.agg(F.array_sort(F.collect_set(F.struct("factor_name", "factor_version"))))
    asked = wanted.select("as_of_date", F.inline(declared.scalar()))
    return asked.join(have, ["as_of_date", "factor_name", "factor_version"], "left_anti")


def top_n_by_factor(
    panel: DataFrame, n: int, bound: int | None = None,
    name: str = TOP_N_NAME, version: str = TOP_N_VERSION,
) -> DataFrame:
    """Ranks eligible finite values, highest first, symbol breaking ties; selects the first ``n``.

    Every universe row is kept: unranked ones have no score, no rank and are not selected.
    """
    if n < 1:
        raise ValueError("at least one name must be selectable")
    scored = panel.select(
        "as_of_date", "symbol", "ord",
        F.when(F.col("is_eligible"), finite_or_null("raw_value")).alias("score"),
    )
    ranked = ordinal_rank(scored, ["as_of_date"], "score", "symbol", "rank", bound)
    return ranked.select(
        "as_of_date",
        F.lit(name).alias("strategy_name"),
        F.lit(version).alias("strategy_version"),
        "symbol", "ord", "score", "rank",
        F.coalesce(F.col("rank") <= n, F.lit(False)).alias("is_selected"),
    )


def selected_scores(result: DataFrame) -> DataFrame:
    return result.where("is_selected").select("as_of_date", "symbol", "ord", "score")
