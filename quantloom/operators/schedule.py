"""Decision and rebalance schedules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import week_start
from ..schemas import WEEKDAYS
from .calendar import session_offset, session_on_or_before


def _within(start: date, end: date):
    return F.col("decision_date").between(F.lit(start), F.lit(end))


def weekly_schedule(calendar: DataFrame, start: date, end: date, anchor: str = "THU") -> DataFrame:
    """Per ISO week the anchor weekday, or the last session before it.

    The session may fall in the week before; it is kept only inside ``[start, end]``.
    Probes the calendar does not cover are skipped.
    """
    spark = calendar.sparkSession
    first_probe = F.date_add(week_start(F.lit(start)), WEEKDAYS[anchor])
    # `sequence` would count downwards, so an anchor past `end` needs its own empty case
    probes = spark.range(1).select(
        F.explode(
            F.when(
                first_probe <= F.lit(end),
                F.sequence(first_probe, F.lit(end), F.expr("interval 7 days")),
            )
        ).alias("probe")
    )
    found = session_on_or_before(probes, calendar, "probe")
    return found.select(F.col("session").alias("decision_date")).where(_within(start, end))


def biweekly_schedule(calendar: DataFrame, start: date, end: date, anchor: str = "THU") -> DataFrame:
    """Every second kept weekly date, starting with the first."""
    weekly = weekly_schedule(calendar, start, end, anchor)
    position = F.row_number().over(Window.orderBy("decision_date"))
    return weekly.withColumn("position", position).where("position % 2 = 1").drop("position")


def monthly_schedule(calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Last session of each calendar month; months cut by the window keep their true end."""
    return (
        calendar.groupBy(F.trunc("session", "month").alias("month"))
        .agg(F.max("session").alias("decision_date"))
        .select("decision_date")
        .where(_within(start, end))
    )


def decision_schedule(
    calendar: DataFrame, start: date, end: date, frequency: str = "weekly", anchor: str = "THU"
) -> DataFrame:
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    if frequency == "monthly":
        return monthly_schedule(calendar, start, end)
    rule = {"weekly": weekly_schedule, "biweekly": biweekly_schedule}[frequency]
    return rule(calendar, start, end, anchor)


def with_execution(
    decisions: DataFrame, calendar: DataFrame, end: date, delay: int = 1
) -> DataFrame:
    """Decisions with the session ``delay`` later; NULL when it lies past ``end``."""
    if delay < 1:
        raise ValueError("a decision executes at least one session later")
    moved = session_offset(decisions, calendar, "decision_date", delay, "execution_date")
    return moved.withColumn(
        "execution_date", F.when(F.col("execution_date") <= F.lit(end), F.col("execution_date"))
    )


def rebalance_schedule(
    calendar: DataFrame, start: date, end: date,
    frequency: str = "weekly", anchor: str = "THU", delay: int = 1,
) -> DataFrame:
    """``(decision_date, execution_date)`` of the decisions that complete inside the window."""
    decisions = decision_schedule(calendar, start, end, frequency, anchor)
    return with_execution(decisions, calendar, end, delay).where("execution_date is not null")


def unexecuted_decisions(decisions: DataFrame, events: DataFrame) -> DataFrame:
    return decisions.join(events, "decision_date", "left_anti")
