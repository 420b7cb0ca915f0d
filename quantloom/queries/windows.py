"""Window functions, orderings and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as bar_ops
from ..operators import evaluation, execution, planning, quality, ranking, selection
from ..operators.calendar import last_sessions
from ..operators.contracts import repeated
from ..operators.weights import weight_refusals
from .inputs import CAP, CASH, PLAN_END, PLAN_START, TOP_N, Market
from .registry import query

PANEL_SQL = "SELECT as_of_date, symbol, ord, factor_name, factor_version, raw_value, is_eligible FROM o_panel"


@query("momentum_12_1", PANEL_SQL, dates=["as_of_date"])
def momentum(m: Market):
    return m.panel


@query("momentum_per_symbol_python", """
SELECT as_of_date, symbol, ord, 'range_13w' AS factor_name, '1.0.0' AS factor_version, v AS raw_value,
       v IS NOT NULL AS is_eligible
FROM o_grid LEFT JOIN (
  SELECT symbol, date AS as_of_date, CASE WHEN count(*) OVER w = 13 THEN max(high) OVER w / min(low) OVER w END AS v
  FROM o_bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
) USING (as_of_date, symbol)""", dates=["as_of_date"])
def pandas_factor(m: Market):
    """A user's own rule in Python: the 13-row high-low range, one symbol at a time."""
    from ..operators.panel import pandas_factor as wrap

    def rule(history):
        history = history.sort_values("date")
        value = history["high"].rolling(13).max() / history["low"].rolling(13).min()
        out = history[["symbol"]].assign(as_of_date=history["date"], raw_value=value)
        out["is_eligible"] = out["raw_value"].notna()
        return out[["as_of_date", "symbol", "raw_value", "is_eligible"]]

    return wrap(rule, "range_13w", "1.0.0", ["high", "low"])(m.bars, m.dates, m.pool, m.calendar)


TIES = """
SELECT p_partkey, p_brand, p_size,
       rank() OVER (PARTITION BY p_brand ORDER BY p_size)
         + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS average_rank FROM part"""


@query("average_rank", TIES)
def average_rank(m: Market):
    """Part sizes inside a brand: many ties."""
    rows = m.table("part").select("p_partkey", "p_brand", "p_size")
    bound = rows.limit(ranking.WINDOW_ROWS + 1).count()
    return ranking.average_rank(rows, ["p_brand"], "p_size", bound=bound)


@query("average_rank_sliced", TIES)
def average_rank_sliced(m: Market):
    rows = m.table("part").select("p_partkey", "p_brand", "p_size")
    return ranking.average_rank(rows, ["p_brand"], "p_size")


@query("quantile_assign", """
SELECT as_of_date, symbol, raw_value, quantile FROM o_groups""", dates=["as_of_date"])
def quantile_assign(m: Market):
    rows = evaluation.assign_quantiles(m.pairs, bound=m.bound).where("quantile is not null")
    return rows.select("as_of_date", "symbol", "raw_value", "quantile")


@query("top_n_by_factor", "SELECT * FROM o_result", dates=["as_of_date"])
def top_n_by_factor(m: Market):
    return m.result


@query("top_n_by_factor_sliced", "SELECT * FROM o_result", dates=["as_of_date"])
def top_n_by_factor_sliced(m: Market):
    return selection.top_n_by_factor(m.panel, TOP_N)


@query("pct_change", """
SELECT symbol, date, adjusted_close / lag(adjusted_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS daily_return
FROM o_bars""", dates=["date"])
def pct_change(m: Market):
    return bar_ops.derive_features(m.bars).select("symbol", "date", "daily_return")


@query("capped_score_weights", "SELECT * FROM o_pos", dates=["as_of_date"], rounded=["weight"])
def capped_score_weights(m: Market):
    return m.positions


@query("weight_refusals", """
SELECT CASE WHEN score > 0 THEN 'infeasible_cap' ELSE 'non_positive_score' END AS rule, as_of_date, symbol
FROM o_result WHERE rank <= 20 AND score <= 0""", dates=["as_of_date"])
def refusals(m: Market):
    """Twenty names a date reach down to falling prices, which have no positive share."""
    wide = selection.top_n_by_factor(m.stored_panel, 20, m.bound)
    return weight_refusals(selection.selected_scores(wide), CASH, CAP)


@query("date_monotonic", """
SELECT 'date_not_increasing' AS rule, symbol || '|' || CAST(date AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value
FROM (SELECT symbol, date, date > lag(date) OVER (PARTITION BY symbol ORDER BY date) AS up FROM o_damaged) GROUP BY symbol, date
HAVING bool_or(up = FALSE)""")
def date_monotonic(m: Market):
    """Sorted by date, a repeated date is the only way to break the rule."""
    return repeated(m.damaged, "date_not_increasing", "symbol", "date")


@query("gap_runs", "SELECT symbol, s0, s1, reason FROM o_runs")
def gap_runs(m: Market):
    return planning.gap_runs(m.held_dates, m.calendar, PLAN_START, PLAN_END)


@query("merge_windows", "SELECT symbol, s0, s1, reason FROM o_windows")
def merge_windows(m: Market):
    runs = planning.gap_runs(m.held_dates, m.calendar, PLAN_START, PLAN_END)
    last = m.calendar.where(F.col("session") <= F.lit(PLAN_END)).agg(F.max("sid")).scalar()
    refresh = m.held_dates.select("symbol").distinct().select(
        "symbol", (last - 4).alias("s0"), last.alias("s1"), F.lit(planning.OVERLAP).alias("reason")
    )
    return planning.merge_windows(runs.unionByName(refresh))


@query("session_index", "SELECT * FROM o_bdays", dates=["session"])
def session_index(m: Market):
    return m.business_days


@query("order_bars", "SELECT * FROM o_bars", dates=["date"])
def order_bars(m: Market):
    return bar_ops.order_bars(m.bars)


@query("head_tail_sample", """
SELECT *, 'head' AS part FROM (SELECT date, symbol, close FROM o_bars ORDER BY date, symbol LIMIT 3)
UNION ALL SELECT *, 'tail' FROM (SELECT date, symbol, close FROM o_bars ORDER BY date DESC, symbol DESC LIMIT 3)
""", dates=["date"])
def head_tail_sample(m: Market):
    return quality.head_tail_sample(m.bars.select("date", "symbol", "close"))


@query("top_n", "SELECT as_of_date, symbol, score, rank FROM o_result WHERE rank <= 3", dates=["as_of_date"])
def top_n(m: Market):
    return m.result.where("rank <= 3").select("as_of_date", "symbol", "score", "rank")


@query("last_n_sessions", """
SELECT session, sid FROM o_bdays WHERE session <= DATE '2000-12-31' ORDER BY session DESC LIMIT 7""", dates=["session"])
def last_n_sessions(m: Market):
    from datetime import date

    return last_sessions(m.business_days, date(2000, 12, 31), 7)


@query("report_order", """
SELECT fill_date, order_id, row_number() OVER (ORDER BY fill_date, order_id) > 0 AS listed FROM o_fills""",
       dates=["fill_date"])
def report_order(m: Market):
    return execution.order_fills(m.fills).select("fill_date", "order_id", F.lit(True).alias("listed"))
