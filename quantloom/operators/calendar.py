"""Sessions: the calendar is a table ``(session DATE, sid BIGINT)``.

A calendar has one row per trading day, about 250 a year, so it stays small however many
symbols or trades there are. Nothing here hints a broadcast: the optimizer broadcasts
it when its measured size allows and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def session_calendar(dates: DataFrame, column: str = "date") -> DataFrame:
    """Distinct days, numbered from 1 in date order."""
    days = dates.select(F.to_date(column).alias("session")).where("session is not null").distinct()
    # the only ordering over the whole table runs on distinct days
    return days.withColumn("sid", F.row_number().over(Window.orderBy("session")).cast("bigint"))


def day_map(calendar: DataFrame, until: Column | None = None) -> DataFrame:
    """Every calendar day with the session on or before it: ``(day, session, sid, next_session)``.

    Turns backward as-of lookups into equi-joins on ``day``; ``until`` extends the cover
    of the last session.
    """
    nxt = F.lead("session").over(Window.orderBy("session"))
    last = F.col("session") if until is None else F.greatest(F.col("session"), until)
    return calendar.withColumn("next_session", nxt).select(
        F.explode(
            F.sequence(
                "session",
                F.coalesce(F.date_sub("next_session", 1), last),
                F.expr("interval 1 day"),
            )
        ).alias("day"),
        "session", "sid", "next_session",
    )


def sessions_in_range(calendar: DataFrame, start, end) -> DataFrame:
    return calendar.where(F.col("session").between(F.lit(start), F.lit(end)))


def keep_sessions(df: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """Rows whose day is a session."""
    return df.join(calendar.select(F.col("session").alias(column)), column, "left_semi")


def off_session(df: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """Rows whose day is not a session: refused, never moved to a neighbour."""
    return df.join(calendar.select(F.col("session").alias(column)), column, "left_anti")


def session_on_or_before(
    df: DataFrame, calendar: DataFrame, column: str, until: Column | None = None
) -> DataFrame:
    """Adds ``session`` and ``sid``: the last session on or before ``column``, else NULL.

    ``until`` must be at least the latest probe when probes may lie past the last session.
    """
    lookup = day_map(calendar, until).select(F.col("day").alias(column), "session", "sid")
    return df.join(lookup, column, "left")


def next_session_after(df: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """Adds ``next_session``: the first session strictly after ``column``, else NULL."""
    first = calendar.agg(F.min("session").alias("first"))
    lookup = day_map(calendar).select(F.col("day").alias(column), "next_session")
    return df.join(lookup, column, "left").withColumn(
        "next_session",
        F.coalesce(
            "next_session",
            F.when(F.col(column) < first.scalar(), first.scalar()),
        ),
    )


def session_offset(
    df: DataFrame, calendar: DataFrame, column: str, sessions: int, out: str
) -> DataFrame:
    """Adds ``out``: the session ``sessions`` after the session ``column``, else NULL."""
    pairs = calendar.select(
        F.col("session").alias(column),
        F.lead("session", sessions).over(Window.orderBy("session")).alias(out),
    )
    return df.join(pairs, column, "left")


def last_sessions(calendar: DataFrame, end, count: int) -> DataFrame:
    """The ``count`` most recent sessions up to ``end``."""
    return calendar.where(F.col("session") <= F.lit(end)).orderBy(F.desc("session")).limit(count)
