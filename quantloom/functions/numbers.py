"""Finite checks, tolerant comparison and overflow-safe moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")
_SMALLEST_NORMAL = 2.2250738585072014e-308


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_finite(x) -> Column:
    """Neither NULL, NaN nor infinite. Spark orders NaN above every number, so
    ``abs(x) < inf`` alone already rejects NaN and both infinities."""
    return F.coalesce(F.abs(_c(x)) < F.lit(_INF), F.lit(False))


def finite_or_null(x) -> Column:
    return F.when(is_finite(x), _c(x))


def is_positive(x) -> Column:
    return is_finite(x) & (_c(x) > 0)


def is_non_negative(x) -> Column:
    return is_finite(x) & (_c(x) >= 0)


def usable_price(x) -> Column:
    """The value when it is finite and above zero, else NULL."""
    return F.when(is_positive(x), _c(x))


def clamp(x, low, high) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), _c(x)))


def agrees(a, b, tolerance: float) -> Column:
    """Both undefined, or both defined and within ``tolerance``."""
    a, b = _c(a), _c(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(
        F.abs(a - b) <= F.lit(tolerance)
    )


def mean_of(x) -> Column:
    """Mean that stays finite when the plain sum leaves the double range.

    Scaling by a power of two is exact, so the fallback loses nothing.
    """
    x = _c(x)
    plain, scaled = F.avg(x), F.avg(x * F.lit(2.0**-64)) * F.lit(2.0**64)
    return F.when(plain.isNotNull(), F.when(is_finite(plain), plain).otherwise(scaled))


def moments_of(x) -> dict[str, Column]:
    """Mean, population deviation, minimum and maximum of a finite sample, one pass.

    The deviation of a flat sample is exactly 0; samples whose squares overflow or
    fall below the normal range are measured on a copy scaled by a power of two.
    """
    x = _c(x)
    low, high = F.min(x), F.max(x)
    plain = F.stddev_pop(x)
    down = F.stddev_pop(x * F.lit(2.0**-540)) * F.lit(2.0**540)
    up = F.stddev_pop(x * F.lit(2.0**600)) * F.lit(2.0**-600)
    std = (
        F.when(F.count(x) == 0, F.lit(None).cast("double"))
        .when(low == high, F.lit(0.0))
        .when(~is_finite(plain), down)
        .when(plain * plain < F.lit(_SMALLEST_NORMAL), up)
        .otherwise(plain)
    )
    return {"mean": mean_of(x), "std": std, "min": low, "max": high}
