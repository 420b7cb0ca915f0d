"""Strategy and portfolio runs over stored panels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.contracts import portfolio_violations, strategy_violations
from ..operators.selection import context_panels, missing_panels, selected_scores
from ..operators.transition import (
    portfolio_transition, previous_target, transition_status, transition_totals,
)
from ..operators.weights import target_cash, water_fill, weight_refusals
from ..session import durable

Strategy = Callable[[DataFrame], DataFrame]  # panel of all dates -> result of all dates
Rule = Callable[[DataFrame, float, float], DataFrame]  # (selected, cash, cap) -> rows of all dates


def _stop_on(problems: DataFrame, what: str) -> None:
    sample = problems.limit(5).collect()
    if sample:
        raise ValueError(f"{what}: {[row.asDict() for row in sample]}")


def strategy_run(
    panels: DataFrame, requirements: DataFrame, dates: DataFrame, grid: DataFrame, strategy: Strategy
) -> DataFrame:
    """Reads exactly the required panels, computes, checks; every date in one job.

    ``grid`` is ``(as_of_date, symbol, ord)`` and gives the panel rows their universe order.
    """
    _stop_on(missing_panels(panels, requirements, dates), "required panels are not stored")
    covered = grid.join(dates, "as_of_date", "left_semi")
    asked = context_panels(panels, requirements).join(dates, "as_of_date", "left_semi")
    strange = asked.join(covered, ["as_of_date", "symbol"], "left_anti").select("as_of_date", "symbol")
    _stop_on(strange, "panel rows outside the universe")
    panel = asked.join(covered, ["as_of_date", "symbol"])
    result = durable(strategy(panel), "strategy")
    _stop_on(strategy_violations(result, covered), "the strategy result breaks its contract")
    return result


def portfolio_run(
    result: DataFrame, cash: float, cap: float,
    state: DataFrame | None = None, state_cash: DataFrame | None = None,
    construct: Rule = water_fill, refuse: Rule = weight_refusals,
) -> dict[str, DataFrame]:
    """Targets, moves and totals of every date that can be weighted.

    ``construct`` may be any rule that returns positions, with ``refuse`` naming the dates it
    cannot weight; it gets the selections of the other dates.

    Without an explicit ``state`` each date starts from the target of the date before, and the
    first one from cash.
    """
    selected = selected_scores(result)
    refused = durable(refuse(selected, cash, cap), "refusals")
    left_out = refused.select("as_of_date").distinct()
    allowed = selected.join(left_out, "as_of_date", "left_anti")
    target = durable(construct(allowed, cash, cap), "target")
    wanted_cash = durable(target_cash(result, cash).join(left_out, "as_of_date", "left_anti"), "target-cash")
    _stop_on(portfolio_violations(target, wanted_cash, selected), "the target breaks its contract")
    if state is None:
        state, state_cash = previous_target(target, wanted_cash)
    moves = portfolio_transition(state, target).withColumn("status", transition_status())
    return {
        "refusals": refused, "target": target, "cash": wanted_cash, "transition": moves,
        "totals": transition_totals(moves, state_cash, wanted_cash),
    }


def all_cash(dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The empty starting state of every date."""
    cash = dates.select("as_of_date", F.lit(1.0).alias("cash_weight"))
    nothing = dates.where(F.lit(False)).select(
        "as_of_date", F.lit("").alias("symbol"), F.lit(0).cast("bigint").alias("ord"), F.lit(0.0).alias("weight")
    )
    return nothing, cash
