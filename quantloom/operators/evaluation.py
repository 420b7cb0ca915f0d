"""How well a factor ordered the future: rank correlation and quantile returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, mean_of
from ..schemas import MIN_PAIRS, QUANTILES
from .ranking import doubled_rank, ranked_count

KEY = ["as_of_date", "end_date", "factor_name", "factor_version", "horizon_sessions"]


def pair_violations(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Where panel and labels do not describe the same dates, symbols and factor version.

    Anything here means the two must not be joined; an inner join would hide it.
    """
    key = ["as_of_date", "symbol"]
    left = panel.select(*key, "factor_name", "factor_version", F.lit(True).alias("has_panel"))
    right = labels.select(
        *key, F.col("factor_name").alias("label_name"),
        F.col("factor_version").alias("label_version"), F.lit(True).alias("has_label"),
    )
    both = left.join(right, key, "full_outer")
    same = (F.col("factor_name") == F.col("label_name")) & (
        F.col("factor_version") == F.col("label_version")
    )
    rule = (
        F.when(F.col("has_label").isNull(), "missing_label")
        .when(F.col("has_panel").isNull(), "label_without_panel")
        .when(~same, "identity_mismatch")
    )
    return both.select(rule.alias("rule"), *key).where("rule is not null")


def date_closure(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Dates found on one side only."""
    p, q = panel.select("as_of_date"), labels.select("as_of_date")
    return p.subtract(q).withColumn("side", F.lit("panel_only")).unionByName(
        q.subtract(p).withColumn("side", F.lit("labels_only"))
    )


def pair(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Panel rows next to their labels; check :func:`pair_violations` first."""
    return panel.select(
        "as_of_date", "symbol", "factor_name", "factor_version", "raw_value", "is_eligible"
    ).join(
        labels.select("as_of_date", "symbol", "end_date", "horizon_sessions", "forward_return", "is_available"),
        ["as_of_date", "symbol"],
    )


def with_usable(pairs: DataFrame) -> DataFrame:
    """Adds ``x`` and ``y``: value and return where both may be used, else NULL."""
    ok = (
        F.col("is_eligible") & is_finite("raw_value")
        & F.col("is_available") & is_finite("forward_return")
    )
    return pairs.withColumn("x", F.when(ok, F.col("raw_value"))).withColumn(
        "y", F.when(ok, F.col("forward_return"))
    )


def usable_pairs(pairs: DataFrame) -> DataFrame:
    return with_usable(pairs).where("x is not null").drop("x", "y")


def daily_ic(pairs: DataFrame, min_pairs: int = MIN_PAIRS, bound: int | None = None) -> DataFrame:
    """Rank correlation per date; NULL below ``min_pairs`` or when a side is constant.

    Ranks are doubled so every sum is an exact integer and the answer does not depend on
    row order. A perfect order is +-1 exactly: equal ranks throughout, or a constant rank sum.
    """
    rows = doubled_rank(with_usable(pairs), KEY, "x", "a", bound)
    rows = doubled_rank(rows, KEY, "y", "b", bound)

    def total(x):
        return F.sum(x.cast("decimal(38,0)"))

    a, b = F.col("a"), F.col("b")
    sums = rows.groupBy(*KEY).agg(
        F.count("*").alias("universe_size"),
        F.count("x").alias("paired_count"),
        total(a * b).alias("sab"), total(a * a).alias("saa"), total(b * b).alias("sbb"),
        F.every(a == b).alias("same_order"),
        (F.min(a + b) == F.max(a + b)).alias("reverse_order"),
    )
    n = F.col("paired_count").cast("decimal(19,0)")
    centre = n * (n + 1) * (n + 1)

    def spread(name):
        return (F.col(name) - centre).cast("double")

    ratio = F.try_divide(spread("sab"), F.sqrt(spread("saa")) * F.sqrt(spread("sbb")))
    ic = F.when(
        (F.col("paired_count") >= min_pairs) & (spread("saa") > 0) & (spread("sbb") > 0),
        F.when(F.col("same_order"), F.lit(1.0))
        .when(F.col("reverse_order"), F.lit(-1.0))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), ratio))),
    )
    return sums.select(
        *KEY, "universe_size", "paired_count",
        (F.col("paired_count") / F.col("universe_size")).alias("pair_coverage"),
        ic.alias("ic"),
    )


def ic_summary(ics: DataFrame) -> DataFrame:
    """Mean, sample deviation and their ratio over the dates with a defined value."""
    std = F.stddev_samp("ic")
    std = F.when(F.min("ic") == F.max("ic"), F.when(F.count("ic") > 1, F.lit(0.0))).otherwise(std)
    return ics.groupBy("factor_name", "factor_version", "horizon_sessions").agg(
        F.count("ic").alias("valid_ic_count"),
        F.avg("ic").alias("mean_ic"),
        std.alias("ic_std"),
        F.when(F.count("ic") > 1, F.try_divide(F.avg("ic"), F.nullif(std, F.lit(0.0)))).alias("icir"),
    )


def assign_quantiles(pairs: DataFrame, quantiles: int = QUANTILES, bound: int | None = None) -> DataFrame:
    """Adds ``quantile`` in 1..Q from the average rank; ties are never split.

    ``ceil(rank * Q / n)`` on whole numbers: with the rank doubled there is no rounding.
    """
    rows = ranked_count(with_usable(pairs), KEY, "x", "n", bound)
    rows = doubled_rank(rows, KEY, "x", "a", bound)
    q = F.expr(f"(a * {quantiles} + 2 * n - 1) div (2 * n)")
    return rows.withColumn(
        "quantile",
        F.when(F.col("x").isNotNull(), F.least(F.lit(quantiles), F.greatest(F.lit(1), q)).cast("int")),
    ).drop("a", "n")


def quantile_returns(pairs: DataFrame, quantiles: int = QUANTILES, bound: int | None = None) -> DataFrame:
    """Per date and group: members and equal-weighted mean return; empty groups stay as rows."""
    rows = assign_quantiles(pairs, quantiles, bound)
    groups = []
    for q in range(1, quantiles + 1):
        mine = F.col("quantile") == q
        groups.append(
            F.struct(
                F.lit(q).alias("quantile"),
                F.count_if(mine).alias("member_count"),
                mean_of(F.when(mine, F.col("y"))).alias("mean_forward_return"),
            )
        )
    per_date = rows.groupBy(*KEY).agg(
        F.count("*").alias("universe_size"),
        F.count("x").alias("paired_count"),
        F.array(*groups).alias("groups"),
    )
    return per_date.select(
        *KEY, "universe_size", "paired_count", F.inline("groups")
    ).select(
        *KEY, F.lit(quantiles).alias("quantiles"), "quantile", "universe_size", "paired_count",
        (F.col("paired_count") / F.col("universe_size")).alias("paired_coverage"),
        "member_count",
        (F.col("member_count") / F.col("universe_size")).alias("member_coverage"),
        "mean_forward_return",
    )


def quantile_spread(observations: DataFrame) -> DataFrame:
    """Top minus bottom mean return per date; NULL when either group is empty."""

    def mean_at(q):
        return F.max(F.when(F.col("quantile") == q, F.col("mean_forward_return")))

    ends = observations.groupBy(*KEY, "quantiles").agg(
        mean_at(F.lit(1)).alias("bottom_mean_forward_return"),
        mean_at(F.col("quantiles")).alias("top_mean_forward_return"),
    )
    gap = F.col("top_mean_forward_return") - F.col("bottom_mean_forward_return")
    return ends.withColumn("top_minus_bottom", F.when(is_finite(gap), gap))
