import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from quantloom.operators import contracts, evaluation, panel

from .conftest import rows

PAIR = (
    "as_of_date date, symbol string, end_date date, factor_name string, factor_version string, "
    "horizon_sessions bigint, raw_value double, is_eligible boolean, forward_return double, is_available boolean"
)
A, B = date(2024, 1, 4), date(2024, 2, 5)


def pairs(spark, values, returns, day=A):
    data = [
        (day, f"S{i:02d}", B, "f", "1", 5, v, v is not None, r, r is not None)
        for i, (v, r) in enumerate(zip(values, returns))
    ]
    return spark.createDataFrame(data, PAIR)


def ic(spark, values, returns, bound=100, **kw):
    return evaluation.daily_ic(pairs(spark, values, returns), bound=bound, **kw).head()


@pytest.mark.parametrize("bound", [100, None])
def test_tied_values(spark, bound):
    assert ic(spark, [1.0, 1.0, 2.0, 3.0], [.01, .02, .03, .04], bound)["ic"] == pytest.approx(0.9486832980505138, abs=1e-15)


def test_perfect_orders_are_exact(spark):
    up = [float(i) for i in range(37)]
    assert ic(spark, up, [x * x for x in up])["ic"] == 1.0
    assert ic(spark, up, [-x for x in up])["ic"] == -1.0


@pytest.mark.parametrize("values,returns", [
    ([1.0, 1.0, 1.0], [.1, .2, .3]), ([1.0, 2.0, 3.0], [.1, .1, .1]), ([1.0, None], [.1, .2]),
    ([None, None], [None, None]), ([1.0, math.inf], [.1, .2]), ([1.0, math.nan, 2.0], [.1, .2, None]),
])
def test_undefined_is_null(spark, values, returns):
    assert ic(spark, values, returns)["ic"] is None


def test_pair_coverage_counts_the_universe(spark):
    got = ic(spark, [1.0, 2.0, None, 4.0], [.1, .2, .3, None])
    assert (got["universe_size"], got["paired_count"], got["pair_coverage"], got["ic"]) == (4, 2, 0.5, 1.0)


def test_monotone_transform_and_row_order_change_nothing(spark):
    values, returns = [3.0, -1.0, 2.5, 8.0, 0.5], [.2, .1, -.4, .3, .05]
    base = ic(spark, values, returns)["ic"]
    moved = pairs(spark, [math.exp(v) for v in values], returns).orderBy(F.desc("symbol")).repartition(3)
    assert evaluation.daily_ic(moved, bound=10).head()["ic"] == base


def test_summary_of_opposite_days(spark):
    both = pairs(spark, [1.0, 2.0], [.1, .2]).unionByName(pairs(spark, [1.0, 2.0], [.2, .1], date(2024, 1, 11)))
    got = evaluation.ic_summary(evaluation.daily_ic(both, bound=10)).head()
    assert (got["valid_ic_count"], got["mean_ic"], got["icir"]) == (2, 0.0, 0.0)
    assert got["ic_std"] == pytest.approx(math.sqrt(2))


def test_summary_needs_two_days_and_a_spread(spark):
    one = evaluation.ic_summary(evaluation.daily_ic(pairs(spark, [1.0, 2.0], [.1, .2]), bound=10)).head()
    assert (one["valid_ic_count"], one["ic_std"], one["icir"]) == (1, None, None)
    same = pairs(spark, [1.0, 2.0], [.1, .2]).unionByName(pairs(spark, [1.0, 2.0], [.1, .2], date(2024, 1, 11)))
    flat = evaluation.ic_summary(evaluation.daily_ic(same, bound=10)).head()
    assert (flat["ic_std"], flat["icir"]) == (0.0, None)


@pytest.mark.parametrize("bound", [100, None])
@pytest.mark.parametrize("values,q,want", [
    ([1.0, 2.0], 5, [3, 5]), ([1.0, 1.0, 1.0, 1.0, 2.0, 3.0], 3, [2, 2, 2, 2, 3, 3]),
    ([float(i) for i in range(10)], 5, [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]),
])
def test_quantile_groups(spark, values, q, want, bound):
    got = evaluation.assign_quantiles(pairs(spark, values, [.1] * len(values)), q, bound)
    assert [r[1] for r in rows(got, "symbol", "quantile")] == want


def test_spread_of_two_groups(spark):
    obs = evaluation.quantile_returns(pairs(spark, [.1, .2, .3, .4], [.5, .25, .25, -.5]), 2, 10)
    assert [r[1] for r in rows(obs, "quantile", "mean_forward_return")] == [.375, -.125]
    assert evaluation.quantile_spread(obs).head()["top_minus_bottom"] == -.5


def test_empty_groups_stay_and_spread_is_null(spark):
    obs = evaluation.quantile_returns(pairs(spark, [1.0, 2.0], [.1, .2]), 5, 10)
    assert [r[1] for r in rows(obs, "quantile", "member_count")] == [0, 0, 1, 0, 1]
    assert evaluation.quantile_spread(obs).head()["top_minus_bottom"] is None
    assert contracts.quantile_block_consistency(obs, evaluation.quantile_spread(obs)).count() == 0


def test_huge_returns_keep_a_finite_mean(spark):
    obs = evaluation.quantile_returns(pairs(spark, [1.0, 1.0], [1e308, 1e308]), 1, 10)
    assert obs.head()["mean_forward_return"] == 1e308


def panel_of(spark, values, eligible):
    data = [(A, f"S{i}", "f", "1", v, e) for i, (v, e) in enumerate(zip(values, eligible))]
    return spark.createDataFrame(
        data, "as_of_date date, symbol string, factor_name string, factor_version string, raw_value double, is_eligible boolean"
    )


def test_panel_statistics_of_three(spark):
    got = panel.panel_statistics(panel_of(spark, [.25, math.nan, .75], [True, False, True])).head()
    assert (got["universe_size"], got["eligible_count"], got["valid_count"], got["missing_count"]) == (3, 2, 2, 1)
    assert (got["mean"], got["std"], got["minimum"], got["maximum"]) == (.5, .25, .25, .75)


@pytest.mark.parametrize("values,mean,std", [
    ([1e308, 1e308], 1e308, 0.0), ([1e308, -1e308], 0.0, 1e308), ([1e-200, 3e-200], 2e-200, 1e-200),
    ([.1, .1, .1], .1, 0.0), ([5.0], 5.0, 0.0),
])
def test_moments_at_the_edges_of_the_range(spark, values, mean, std):
    got = panel.panel_statistics(panel_of(spark, values, [True] * len(values))).head()
    assert got["mean"] == pytest.approx(mean, rel=1e-12)
    assert got["std"] == pytest.approx(std, rel=1e-12)


def test_no_valid_value_gives_null_moments(spark):
    got = panel.panel_statistics(panel_of(spark, [math.inf, None], [True, False])).head()
    assert (got["valid_count"], got["mean"], got["std"], got["minimum"]) == (0, None, None, None)


def test_quality_issues(spark):
    clean = panel.panel_quality(panel_of(spark, [1.0, 2.0], [True, True]))
    assert clean.count() == 0
    got = rows(panel.panel_quality(panel_of(spark, [math.nan, math.inf, None], [True, False, False])), "code", "affected_count")
    assert got == [("eligible_non_finite_value", 1), ("ineligible_infinite_value", 1), ("partial_eligible_coverage", 2)]
    none = panel.panel_quality(panel_of(spark, [None], [False]))
    assert rows(none, "code", "severity") == [("zero_eligible_coverage", "error")]


def test_closure_is_reported_not_dropped(spark):
    left = panel_of(spark, [1.0, 2.0], [True, True])
    right = left.where("symbol = 'S0'").withColumn("factor_version", F.lit("2"))
    assert rows(evaluation.pair_violations(left, right), "rule", "symbol") == [
        ("identity_mismatch", "S0"), ("missing_label", "S1"),
    ]
