"""Day parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strict_date(x) -> Column:
    """A DATE only for text of exactly ``YYYY-MM-DD`` naming a real day."""
    x = _c(x)
    return F.when(x.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), x.try_cast("date"))


def lenient_date(x) -> Column:
    """The day named by the first ten characters, so timestamps in text pass."""
    return F.substring(_c(x), 1, 10).try_cast("date")


def session_day(x) -> Column:
    """A timestamp or date cut to its day (session time zone UTC)."""
    return F.to_date(_c(x))


def week_start(x) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", _c(x)))


def weekday_index(x) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(_c(x))


def month_end(x) -> Column:
    return F.last_day(_c(x))
