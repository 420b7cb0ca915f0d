"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts, evaluation, merge, panel, quality
from ..operators.transition import transition_totals as totals
from ..sources.panels import cache_plan
from .inputs import Market
from .registry import query

STAT_ROUNDED = ["mean", "std"]


def _unadjusted(m: Market):
    """Damaged bars without adjusted closes in one year and without traded value in another."""
    year = F.year("date")
    return m.damaged.withColumns({
        "adjusted_close": F.when(year != 1997, F.col("adjusted_close")),
        "dollar_volume": F.when(year != 1998, F.col("dollar_volume")),
    })


UNADJUSTED = """
(SELECT * REPLACE (CASE WHEN year(date) <> 1997 THEN adjusted_close END AS adjusted_close,
                   CASE WHEN year(date) <> 1998 THEN dollar_volume END AS dollar_volume) FROM o_damaged)"""


@query("verify_dataset", f"""
SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date,
       count(*) - count(DISTINCT (symbol, date)) AS duplicate_rows,
       'duplicate (symbol, date) rows; null values in adjusted_close; null values in dollar_volume' AS issues, FALSE AS ok
FROM {UNADJUSTED}""", dates=["min_date", "max_date"])
def verify_dataset(m: Market):
    return quality.verify_dataset(_unadjusted(m)).withColumn("issues", F.array_join("issues", "; "))


@query("verify_without_symbol", f"""
SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, CAST(0 AS BIGINT) AS duplicate_rows,
       'null values in adjusted_close; null values in dollar_volume' AS issues, FALSE AS ok
FROM {UNADJUSTED}""", dates=["min_date", "max_date"])
def verify_without_symbol(m: Market):
    """Without symbols, rows of one day are no duplicates."""
    return quality.verify_dataset(_unadjusted(m).drop("symbol")).withColumn("issues", F.array_join("issues", "; "))


@query("duplicate_rows", "SELECT count(*) - count(DISTINCT (symbol, date)) AS duplicate_rows FROM o_damaged")
def duplicate_rows(m: Market):
    return quality.duplicate_rows(m.damaged)


@query("null_counts", f"""
SELECT 'open' AS "column", count(*) FILTER (open IS NULL) AS null_count FROM {UNADJUSTED}
UNION ALL SELECT 'high', count(*) FILTER (high IS NULL) FROM {UNADJUSTED}
UNION ALL SELECT 'low', -1
UNION ALL SELECT 'close', count(*) FILTER (close IS NULL) FROM {UNADJUSTED}
UNION ALL SELECT 'adjusted_close', count(*) FILTER (adjusted_close IS NULL) FROM {UNADJUSTED}
UNION ALL SELECT 'volume', count(*) FILTER (volume IS NULL) FROM {UNADJUSTED}
UNION ALL SELECT 'dollar_volume', count(*) FILTER (dollar_volume IS NULL) FROM {UNADJUSTED}""")
def null_counts(m: Market):
    """Damaged bars, with one checked column missing altogether."""
    return quality.null_counts(_unadjusted(m).drop("low"))


@query("year_coverage", "SELECT CAST(year(date) AS INT) AS year, count(*) AS row_count FROM o_bars GROUP BY 1")
def year_coverage(m: Market):
    return quality.year_coverage(m.bars)


@query("summarize_dataset", """
SELECT CASE WHEN symbol = 'BRAND.5' THEN NULL ELSE symbol END AS symbol, CAST(year(date) AS INT) AS year,
       count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date FROM o_bars GROUP BY 1, 2
""", dates=["min_date", "max_date"])
def summarize_dataset(m: Market):
    unnamed = F.when(F.col("symbol") != "BRAND.5", F.col("symbol"))
    return quality.summarize_dataset(m.bars.withColumn("symbol", unnamed))


@query("panel_statistics", "SELECT * FROM o_stats", dates=["as_of_date"], rounded=STAT_ROUNDED)
def panel_statistics(m: Market):
    return panel.panel_statistics(m.panel)


@query("panel_statistics_history", "SELECT * FROM o_stats", dates=["as_of_date"], rounded=STAT_ROUNDED)
def panel_statistics_history(m: Market):
    other = m.panel.withColumn("factor_version", F.lit("2.0.0"))
    return panel.statistics_history(m.panel.unionByName(other), "momentum_12_1", "1.0.0")


@query("daily_ic", "SELECT * FROM o_ic", dates=["as_of_date", "end_date"])
def daily_ic(m: Market):
    return m.ics


@query("daily_ic_sliced", "SELECT * FROM o_ic", dates=["as_of_date", "end_date"])
def daily_ic_sliced(m: Market):
    """The same without a bound on the cross-section: ranks from range-partitioned slices."""
    return evaluation.daily_ic(m.pairs, bound=None)


@query("ic_summary", """
SELECT factor_name, factor_version, horizon_sessions, count(ic) AS valid_ic_count, avg(ic) AS mean_ic,
       stddev_samp(ic) AS ic_std, CASE WHEN count(ic) > 1 THEN avg(ic) / nullif(stddev_samp(ic), 0) END AS icir
FROM o_ic GROUP BY ALL""", rounded=["mean_ic", "ic_std", "icir"])
def ic_summary(m: Market):
    return evaluation.ic_summary(m.ics)


@query("quantile_returns", "SELECT * FROM o_obs", dates=["as_of_date", "end_date"], rounded=["mean_forward_return"])
def quantile_returns(m: Market):
    return m.quantiles


@query("quantile_spread", "SELECT * FROM o_spread", dates=["as_of_date", "end_date"],
       rounded=["bottom_mean_forward_return", "top_mean_forward_return", "top_minus_bottom"])
def quantile_spread(m: Market):
    return evaluation.quantile_spread(m.quantiles)


def _suspect(m: Market):
    """A panel with infinities and missing values injected on both sides of eligibility."""
    bad = F.when(F.col("symbol") == "BRAND.2", float("inf")).when(
        (F.col("symbol") == "BRAND.3") & (F.dayofmonth("as_of_date") < 15), F.lit(None)
    ).otherwise(F.col("raw_value"))
    return m.panel.withColumn("raw_value", bad)


SUSPECT = """
(SELECT as_of_date, symbol, factor_name, factor_version, is_eligible,
        CASE WHEN symbol = 'BRAND.2' THEN CAST('inf' AS DOUBLE)
             WHEN symbol = 'BRAND.3' AND day(as_of_date) < 15 THEN NULL ELSE raw_value END AS raw_value FROM o_panel)"""
ISSUES = f"""
SELECT *, bool_or(is_eligible) OVER (PARTITION BY as_of_date) AS any_ok, count(*) OVER (PARTITION BY as_of_date) AS universe_size,
       count(*) FILTER (is_eligible) OVER (PARTITION BY as_of_date) AS eligible_count
FROM {SUSPECT}"""
CODES = """
SELECT *, CASE WHEN any_ok THEN 'partial_eligible_coverage' ELSE 'zero_eligible_coverage' END AS code,
       CASE WHEN any_ok THEN 'warning' ELSE 'error' END AS severity FROM i WHERE NOT is_eligible
UNION ALL SELECT *, 'eligible_non_finite_value', 'error' FROM i WHERE is_eligible AND NOT coalesce(isfinite(raw_value), FALSE)
UNION ALL SELECT *, 'ineligible_infinite_value', 'warning' FROM i WHERE NOT is_eligible AND isinf(raw_value)"""


@query("panel_quality", f"""
WITH i AS ({ISSUES}), c AS ({CODES})
SELECT as_of_date, factor_name, factor_version, universe_size, eligible_count,
       eligible_count / universe_size AS eligible_coverage, code, severity, count(*) AS affected_count
FROM c GROUP BY ALL""", dates=["as_of_date"])
def panel_quality(m: Market):
    return panel.panel_quality(_suspect(m))


@query("panel_quality_symbols", f"""
WITH i AS ({ISSUES}), c AS ({CODES}) SELECT as_of_date, factor_name, factor_version, code, symbol FROM c""",
       dates=["as_of_date"])
def panel_quality_symbols(m: Market):
    return panel.panel_quality_symbols(_suspect(m))


@query("transition_totals", """
SELECT as_of_date, coalesce(b, 0) AS buy_weight, coalesce(s, 0) AS sell_weight,
       c.cash_weight - h.cash_weight AS cash_weight_change,
       0.5 * (coalesce(b, 0) + coalesce(s, 0) + abs(c.cash_weight - h.cash_weight)) AS turnover
FROM o_cash c JOIN o_scash h USING (as_of_date)
LEFT JOIN (SELECT as_of_date, sum(greatest(weight_change, 0)) AS b, sum(greatest(-weight_change, 0)) AS s
           FROM o_move GROUP BY as_of_date) USING (as_of_date)
""", dates=["as_of_date"], rounded=["buy_weight", "sell_weight", "cash_weight_change", "turnover"])
def transition_totals(m: Market):
    return totals(m.transition, m.state[1], m.cash)


@query("merge_report", """
SELECT symbol, count(*) FILTER (old > 0) AS existing_rows, sum(new) AS downloaded_rows, count(*) AS merged_rows,
       count(*) FILTER (new > 0 AND old = 0) AS new_dates, count(*) FILTER (new > 0 AND old > 0) AS replaced_dates,
       min(date) AS min_date, max(date) AS max_date,
       count(*) FILTER (old > 0 AND new = 0) AS retained_rows
FROM (SELECT symbol, date, count(*) FILTER (k = 0) AS old, count(*) FILTER (k = 1) AS new
      FROM (SELECT symbol, date, 0 AS k FROM o_published UNION ALL SELECT symbol, date, 1 FROM o_downloaded)
      GROUP BY symbol, date) GROUP BY symbol""", dates=["min_date", "max_date"], ints=["downloaded_rows"])
def merge_report(m: Market):
    return merge.merge_report(m.published, m.downloaded)


@query("batch_tally", """
SELECT CASE WHEN session < DATE '1999-01-01' THEN 'hit' ELSE 'miss' END AS outcome, count(*) AS row_count
FROM o_cal GROUP BY 1""")
def batch_tally(m: Market):
    stored = m.dates.where("as_of_date < '1999-01-01'")
    return quality.status_tally(cache_plan(m.dates, stored), "outcome")


@query("weight_completeness", """
SELECT as_of_date, coalesce(w, 0) AS invested_weight, cash_weight, abs(coalesce(w, 0) + cash_weight - 1) <= 1e-9 AS is_complete
FROM o_cash LEFT JOIN (SELECT as_of_date, sum(weight) AS w FROM o_pos GROUP BY as_of_date) USING (as_of_date)
""", dates=["as_of_date"], rounded=["invested_weight"])
def weight_completeness(m: Market):
    return contracts.weight_completeness(m.positions, m.cash)


@query("dataset_stats", """
SELECT symbol, lo AS min_date, hi AS max_date, CAST(year(date) AS INT) AS year, count(*) AS row_count
FROM o_bars JOIN (SELECT symbol, min(date) AS lo, max(date) AS hi FROM o_bars GROUP BY symbol) USING (symbol)
GROUP BY ALL""", dates=["min_date", "max_date"])
def dataset_stats(m: Market):
    return quality.dataset_stats(m.bars)
