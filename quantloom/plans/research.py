"""Factor runs, batches and research reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.contracts import panel_violations
from ..operators.evaluation import (
    daily_ic, ic_summary, pair, pair_violations, quantile_returns, quantile_spread,
)
from ..operators.labels import forward_column, forward_returns, label_sessions
from ..operators.panel import (
    Factor, dense_grid, momentum_columns, panel_quality, panel_statistics, timed_prices,
)
from ..schemas import MIN_PAIRS, MOMENTUM_NAME, MOMENTUM_VERSION, QUANTILES
from ..session import durable
from ..sources.panels import cache_plan, read_whole_panels, stored_keys, write_panels
from ..sources.reports import append_run_log, write_report


# (first, last) -> bars of that closed range of days
BarReader = Callable[[date, date], DataFrame]


@dataclass(frozen=True)
class FactorJob:
    """What a run needs besides its dates.

    ``bars`` is a table, or a function that reads a closed range of days of one. ``lookback`` is the number of sessions before a date that the factor
    looks at; without it a run gives the factor all bars up to its last date. ``log`` is where batch manifests are stored.
    """

    factor: Factor
    name: str
    version: str
    bars: DataFrame | BarReader
    universe: DataFrame
    calendar: DataFrame
    store: str
    lookback: int | None = None
    log: str | None = None


def needed_sessions(dates: DataFrame, calendar: DataFrame, lookback: int) -> DataFrame:
    """The sessions from ``lookback`` sessions before a date up to it, for all dates together: the union of their intervals, each session once.

    A date that is no session counts from the last session before it. Calendar-sized, like the windows that make it."""
    marked = calendar.select("session", "sid").join(
        dates.select(F.col("as_of_date").alias("session"), F.lit(True).alias("asked")).distinct(), "session", "full")
    line = Window.orderBy("session")
    placed = marked.withColumn("sid", F.coalesce("sid", F.last("sid", True).over(line)))
    ahead = F.min(F.when(F.col("asked"), F.col("sid"))).over(line.rowsBetween(0, Window.unboundedFollowing))
    return placed.withColumn("ahead", ahead).where(F.col("ahead") - F.col("sid") <= lookback).select("session")


def bars_needed(job: FactorJob, dates: DataFrame) -> DataFrame:
    """The bars that the factor may look at for ``dates``: those of the days between the first and the last needed session, which a reader turns
    into folders, and of them those of needed sessions."""
    if job.lookback is None:
        last = dates.agg(F.max("as_of_date")).head()[0]
        bars = job.bars(date.min, last) if callable(job.bars) else job.bars
        return bars.where(F.col("date") <= F.lit(last))
    needed = durable(needed_sessions(dates, job.calendar, job.lookback), "sessions")
    first, last = needed.agg(F.min("session"), F.max("session")).head()
    if first is None:  # no date has a session up to it
        first = last = date.min
    bars = job.bars(first, last) if callable(job.bars) else job.bars.where(F.col("date").between(F.lit(first), F.lit(last)))
    return bars.join(needed.select(F.col("session").alias("date")), "date", "left_semi")


def momentum_pairs(
    bars: DataFrame, universe: DataFrame, calendar: DataFrame, lookback: int, skip: int, horizon: int
) -> DataFrame:
    """Momentum next to its labels for every date with an end session, from one pass over the bars.

    Value and return are both windows over the bars of a symbol, so they share one shuffle; the
    rows equal :func:`pair` of a stored panel and its labels.
    """
    ends = label_sessions(calendar, horizon)
    value, complete = momentum_columns(lookback, skip)
    both = timed_prices(bars, calendar, lookback).select(
        "symbol", F.col("date").alias("as_of_date"),
        value.alias("raw_value"), complete.alias("complete"),
        forward_column(horizon).alias("forward_return"),
    )
    eligible = F.coalesce(F.col("complete") & F.col("raw_value").isNotNull(), F.lit(False))
    return (
        dense_grid(universe, ends).join(ends, "as_of_date")
        .join(both, ["as_of_date", "symbol"], "left")
        .select(
            "as_of_date", "symbol", "end_date",
            F.lit(MOMENTUM_NAME).alias("factor_name"), F.lit(MOMENTUM_VERSION).alias("factor_version"),
            F.lit(horizon).cast("bigint").alias("horizon_sessions"),
            F.when(eligible, F.col("raw_value")).alias("raw_value"), eligible.alias("is_eligible"),
            "forward_return", F.col("forward_return").isNotNull().alias("is_available"),
        )
    )


def factor_batch(job: FactorJob, dates: DataFrame, force: bool = False, batch_id: str | None = None) -> DataFrame:
    """Computes and stores the panels that are not stored yet, all dates in one job.

    Returns the manifest ``(as_of_date, outcome, status, problems)``, which is appended to the job's log under ``batch_id``. A date whose panel breaks the
    contract is not stored and does not stop the others. Where every date is stored, no bar is read and nothing is computed;
    else the factor gets the bars of its dates' look-back windows only.
    """
    spark = dates.sparkSession
    held = stored_keys(spark, job.store).where(
        (F.col("factor_name") == job.name) & (F.col("factor_version") == job.version)
    )
    plan = durable(cache_plan(dates.select("as_of_date").distinct(), held, force), "cache-plan")
    todo = plan.where("outcome <> 'hit'").select("as_of_date")
    if todo.isEmpty():
        problems = spark.createDataFrame([], "as_of_date date, problems long")
    else:
        panel = durable(job.factor(bars_needed(job, todo), todo, job.universe, job.calendar), "panel")
        problems = durable(
            panel_violations(panel, dense_grid(job.universe, todo))
            .select(F.substring_index("key", "|", 1).try_cast("date").alias("as_of_date"))
            .groupBy("as_of_date").agg(F.count("*").alias("problems")),
            "panel-problems",
        )
        good = panel.join(problems, "as_of_date", "left_anti")
        if not good.isEmpty():
            write_panels(good, job.store)
    done = F.when(F.col("problems") > 0, "failed").otherwise("succeeded")
    manifest = plan.join(problems, "as_of_date", "left").select(
        "as_of_date", "outcome", done.alias("status"), F.coalesce("problems", F.lit(0)).alias("problems")
    )
    if job.log is not None:
        manifest = durable(manifest, "manifest")
        append_run_log(manifest.select(
            F.lit(batch_id or uuid.uuid4().hex).alias("batch_id"), F.lit(job.name).alias("factor_name"), F.lit(job.version).alias("factor_version"), "*"),
            job.log)
    return manifest


def factor_run(job: FactorJob, as_of: date, force: bool = False) -> dict[str, DataFrame]:
    """One date: a batch of one, with its quality issues and statistics. A panel that is not stored as it was written is refused."""
    spark = job.universe.sparkSession
    day = spark.range(1).select(F.lit(as_of).cast("date").alias("as_of_date"))
    manifest = durable(factor_batch(job, day, force), "manifest")
    stored = manifest.where("status = 'succeeded'")
    panel = read_whole_panels(spark, job.store, job.name, job.version, as_of, as_of, stored)
    return {
        "manifest": manifest, "panel": panel,
        "quality": panel_quality(panel), "statistics": panel_statistics(panel),
    }


def require_complete(manifest: DataFrame) -> None:
    """An analysis measures every selected date or none."""
    counts = manifest.agg(
        F.count("*").alias("dates"), F.count_if(F.col("status") != "succeeded").alias("failed")
    ).head()
    if counts["dates"] == 0:
        raise ValueError("the schedule selected no decision date")
    if counts["failed"]:
        raise ValueError(f"{counts['failed']} of {counts['dates']} dates failed")


def factor_research(
    job: FactorJob, dates: DataFrame, horizon: int, *,
    quantiles: int = QUANTILES, min_pairs: int = MIN_PAIRS, bound: int | None = None,
) -> dict[str, DataFrame]:
    """Batch, labels and all evaluation tables over the stored panels of ``dates``; only the years of the dates are read."""
    spark = job.universe.sparkSession
    manifest = durable(factor_batch(job, dates), "manifest")
    require_complete(manifest)
    first, last = manifest.agg(F.min("as_of_date"), F.max("as_of_date")).head()
    panel = read_whole_panels(spark, job.store, job.name, job.version, first, last, manifest).join(
        manifest.select("as_of_date"), "as_of_date", "left_semi"
    )
    bars = job.bars(first, date.max) if callable(job.bars) else job.bars
    labels = durable(forward_returns(panel, bars, job.calendar, horizon), "labels")
    broken = pair_violations(panel, labels).limit(5).collect()
    if broken:
        raise ValueError(f"panels and labels do not describe the same rows: {broken}")
    pairs = pair(panel, labels)
    ics = durable(daily_ic(pairs, min_pairs, bound), "ics")
    groups = durable(quantile_returns(pairs, quantiles, bound), "quantiles")
    return {
        "manifest": manifest,
        "panel_statistics": panel_statistics(panel),
        "forward_returns": labels,
        "ic_observations": ics,
        "ic_summary": ic_summary(ics),
        "quantile_observations": groups,
        "quantile_spreads": quantile_spread(groups),
    }


def research_report(tables: dict[str, DataFrame], root: str, run_id: str, **settings) -> str:
    """Writes the five tables and one metadata record; undefined numbers become null."""
    days = tables["manifest"].agg(
        F.count("*").alias("panel_count"), F.min("as_of_date").alias("first_date"),
        F.max("as_of_date").alias("last_date"),
    )
    metadata = tables["ic_summary"].select(
        F.lit(run_id).alias("research_run_id"), "*",
        *[days.select(c).scalar().alias(c) for c in ("panel_count", "first_date", "last_date")],
        *[F.lit(value).alias(key) for key, value in settings.items()],
    )
    report = {k: v for k, v in tables.items() if k not in ("manifest", "ic_summary")}
    return write_report(root, run_id, report, metadata)
