"""What to download: gaps against the session calendar, for all symbols in one plan.

Gaps are read off the distance between consecutive published sessions, so the
symbol x session grid is never built. Each symbol holds at most one row per session here.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reason_label
from ..schemas import OVERLAP_SESSIONS
from .calendar import session_on_or_before

INITIAL, HEAD, INTERNAL, TAIL, OVERLAP = (
    "initial_backfill", "head_gap", "internal_gap", "tail_gap", "overlap_refresh",
)
_REASONS = [HEAD, INTERNAL, TAIL, OVERLAP]


def _window_bounds(calendar: DataFrame, start: date, end: date) -> DataFrame:
    """First and last sid of the requested window (NULL when it has no session)."""
    return calendar.where(F.col("session").between(F.lit(start), F.lit(end))).agg(
        F.min("sid").alias("w0"), F.max("sid").alias("w1")
    )


def _bounds(calendar: DataFrame, start: date, end: date):
    b = _window_bounds(calendar, start, end)
    return b.select("w0").scalar(), b.select("w1").scalar()


def _coverage(published: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per symbol the last session before and the first session after its published days."""
    spans = published.groupBy("symbol").agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )
    # days outside the calendar would otherwise find no session at all
    last = calendar.agg(F.max("session").alias("d")).scalar()
    first = calendar.agg(F.min("session").alias("d")).scalar()
    low = session_on_or_before(
        spans.withColumn("probe", F.least("min_date", F.date_add(last, 1))),
        calendar, "probe", F.date_add(last, 1),
    ).select(
        "symbol", "min_date", "max_date",
        F.when(F.col("session") == F.col("min_date"), F.col("sid") - 1)
        .otherwise(F.coalesce("sid", F.lit(0))).alias("head_last"),
    )
    return session_on_or_before(
        low.withColumn("probe", F.least("max_date", F.date_add(last, 1))),
        calendar, "probe", F.date_add(last, 1),
    ).select(
        "symbol", "head_last",
        (F.when(F.col("max_date") < first, F.lit(0)).otherwise(F.col("sid")) + 1).alias("tail_first"),
    )


def gap_runs(published: DataFrame, calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Maximal runs of adjacent missing sessions: ``(symbol, s0, s1, reason)``."""
    w0, w1 = _bounds(calendar, start, end)
    cover = _coverage(published, calendar)
    head = cover.select(
        "symbol", w0.alias("s0"), F.least("head_last", w1).alias("s1"), F.lit(HEAD).alias("reason")
    )
    tail = cover.select(
        "symbol", F.greatest("tail_first", w0).alias("s0"), w1.alias("s1"), F.lit(TAIL).alias("reason")
    )
    # one mark in front of the window closes the first run, the lead default closes the last
    held = (
        published.join(calendar.where(F.col("session").between(F.lit(start), F.lit(end))),
                       F.col("date") == F.col("session"))
        .select("symbol", "sid").distinct()
    )
    marks = held.unionByName(
        cover.select("symbol", F.greatest("head_last", w0 - 1).alias("sid"))
    ).join(cover.select("symbol", "tail_first"), "symbol")
    following = F.lead("sid").over(Window.partitionBy("symbol").orderBy("sid"))
    inner = marks.select(
        "symbol",
        (F.col("sid") + 1).alias("s0"),
        (F.coalesce(following, F.least("tail_first", w1 + 1)) - 1).alias("s1"),
        F.lit(INTERNAL).alias("reason"),
    )
    # `least` and `greatest` pass over NULL, so a window without sessions is ruled out by name
    return head.unionByName(inner).unionByName(tail).where(w0.isNotNull() & (F.col("s0") <= F.col("s1")))


def missing_sessions(published: DataFrame, calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Missing sessions one by one, split into head, internal and tail."""
    runs = gap_runs(published, calendar, start, end)
    return runs.select(
        "symbol", "reason", F.explode(F.sequence("s0", "s1")).alias("sid")
    ).join(calendar, "sid").select("symbol", "session", "reason")


def merge_windows(windows: DataFrame) -> DataFrame:
    """Windows ``(symbol, s0, s1, reason)`` that overlap or touch become one.

    Reasons keep their first-seen order; there are only four, so they are four minima, not
    a collected list.
    """
    kind = F.array_position(F.array(*[F.lit(r) for r in _REASONS]), F.col("reason"))
    by_start = Window.partitionBy("symbol").orderBy("s0", "s1", "kind")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(F.col("s0") <= F.col("reach") + 1, 0).otherwise(1)
    seen = [
        F.when(F.col(f"seen_{r}").isNotNull(), F.struct(F.col(f"seen_{r}").alias("at"), F.lit(r).alias("reason")))
        for r in _REASONS
    ]
    return (
        windows.withColumn("kind", kind)
        .withColumn("reach", F.max("s1").over(before))
        .withColumn("at", F.row_number().over(by_start))
        .withColumn("island", F.sum(opened).over(so_far))
        .groupBy("symbol", "island")
        .agg(
            F.min("s0").alias("s0"),
            F.max("s1").alias("s1"),
            *[F.min(F.when(F.col("reason") == r, F.col("at"))).alias(f"seen_{r}") for r in _REASONS],
        )
        .select(
            "symbol", "s0", "s1",
            F.array_sort(F.array_compact(F.array(*seen))).getField("reason").alias("reasons"),
        )
        .withColumn("reason", reason_label("reasons"))
        .drop("reasons")
    )


def plan_download(
    symbols: DataFrame,
    published: DataFrame,
    calendar: DataFrame,
    start: date,
    end: date,
    overlap: int = OVERLAP_SESSIONS,
) -> DataFrame:
    """Download windows of every symbol: ``(symbol, status, window_start, window_end, reason)``.

    A symbol with nothing published gets the requested range, cut to the calendar's own
    bounds; others get their merged gaps plus the last ``overlap`` sessions again. Symbols
    without a window keep one row that says why.
    """
    w0, w1 = _bounds(calendar, start, end)
    symbols = symbols.select(F.upper(F.trim("symbol")).alias("symbol")).distinct()
    known = symbols.join(published.select("symbol").distinct(), "symbol", "left_semi")
    fresh = symbols.join(published.select("symbol").distinct(), "symbol", "left_anti")

    windows = gap_runs(published.join(symbols, "symbol", "left_semi"), calendar, start, end)
    if overlap > 0:
        refresh = known.select(
            "symbol", F.greatest(w1 - overlap + 1, w0).alias("s0"), w1.alias("s1"),
            F.lit(OVERLAP).alias("reason"),
        ).where(w0.isNotNull())
        windows = windows.unionByName(refresh)
    first_day = calendar.select("sid", F.col("session").alias("window_start"))
    last_day = calendar.select("sid", F.col("session").alias("window_end"))
    planned = (
        merge_windows(windows)
        .join(first_day, F.col("s0") == first_day.sid).drop("sid")
        .join(last_day, F.col("s1") == last_day.sid).drop("sid")
        .select("symbol", "window_start", "window_end", "reason")
    )
    edge = calendar.agg(F.min("session").alias("lo"), F.max("session").alias("hi"))
    lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
    backfill = fresh.where(w0.isNotNull()).select(
        "symbol",
        F.greatest(F.lit(start).cast("date"), lo).alias("window_start"),
        F.least(F.lit(end).cast("date"), hi).alias("window_end"),
        F.lit(INITIAL).alias("reason"),
    )
    every = planned.unionByName(backfill)
    status = (
        F.when(F.col("window_start").isNotNull(), "planned")
        .when(w0.isNull(), "no_sessions")
        .otherwise("up_to_date")
    )
    return symbols.join(every, "symbol", "left").select(
        "symbol", status.alias("status"), "window_start", "window_end", "reason"
    )


def short_deliveries(windows: DataFrame, delivered: DataFrame, calendar: DataFrame) -> DataFrame:
    """Windows that returned fewer rows than the calendar has sessions.

    ``delivered`` rows carry the ``window_start`` they were fetched for, as landed raw rows do.
    """
    got = delivered.groupBy("symbol", "window_start").agg(F.count("*").alias("delivered"))
    wanted = _count_sessions(windows.where("window_start is not null"), calendar)
    return (
        wanted.join(got, ["symbol", "window_start"], "left")
        .withColumn("delivered", F.coalesce("delivered", F.lit(0)).cast("bigint"))
        .where("delivered < expected")
        .select("symbol", "window_start", "window_end", "expected", "delivered")
    )


def _count_sessions(windows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Adds ``expected``: sessions in the closed window, as a difference of session numbers."""
    last = calendar.agg(F.max("session").alias("d")).scalar()
    day_before = F.date_sub(F.col("window_start"), 1)
    upper = session_on_or_before(
        windows.withColumn("probe", F.least("window_end", last)), calendar, "probe"
    ).select("symbol", "window_start", "window_end", F.coalesce("sid", F.lit(0)).alias("upto"))
    return session_on_or_before(
        upper.withColumn("probe", F.least(day_before, last)), calendar, "probe"
    ).select(
        "symbol", "window_start", "window_end",
        (F.col("upto") - F.coalesce("sid", F.lit(0))).alias("expected"),
    )
