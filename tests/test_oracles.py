"""Queries against their SQL. The default run takes a cross-section; set QUANTLOOM_ALL=1 for all."""

import os

import pytest

from quantloom.queries import ORACLES, QUERIES

from .compare import compare, duck

SF = "/root/testdata/sf0.01"
CORE = [
    "scan_bars", "read_universe", "panel_range_scan", "panel_cache_plan", "standardize_bars",
    "static_snapshot", "merge_bars", "forward_returns", "pair_violations", "portfolio_transition",
    "fill_orders", "session_offset", "prev_session_or_same", "verify_dataset", "summarize_dataset",
    "panel_statistics", "daily_ic", "ic_summary", "quantile_returns", "quantile_spread", "panel_quality",
    "merge_report", "momentum_12_1", "momentum_per_symbol_python", "average_rank_sliced",
    "top_n_by_factor", "capped_score_weights", "gap_runs", "missing_sessions", "fn_number_checks",
    "next_session_after", "weekly_schedule", "rebalance_schedule", "plan_download", "short_delivery",
    "universe_violations", "bar_violations", "strategy_result_violations", "order_violations",
    "fill_violations", "schedule_violations", "update_log", "incremental_rejects", "misfiled_panels", "factor_batch_manifest", "result_columns",
]
NAMES = list(QUERIES) if os.environ.get("QUANTLOOM_ALL") else CORE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry_has_a_row_per_session(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    assert frame.columns[:2] == ["as_of_date", "end_date"]
    assert frame.count() > 50
    assert frame.where("ic is not null").count() > 0
