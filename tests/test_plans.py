"""The physical plans the operators are meant to get."""

import re

import pytest

from quantloom.queries import QUERIES
from quantloom.queries.inputs import Market

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "daily_ic", "quantile_returns", "forward_returns", "merge_bars", "plan_download", "bar_violations",
    "dense_cross_section", "prev_session_or_same", "short_delivery", "static_snapshot", "top_n_by_factor",
    "portfolio_transition", "weekly_schedule",
])
def test_no_product_joins_row_python_or_sort_aggregates(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SortAggregate"):
        assert node not in plan, node


def test_factor_and_label_share_one_shuffle_by_symbol(spark):
    plan = plan_of(Market(spark, SF, grain="month", lookback=12, skip=1, horizon=1).pairs)
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", plan)) == 1


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(Market(spark, SF).bars)
    read = next(s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_shipdate" in s)
    assert "l_tax" not in read and "l_returnflag" not in read
