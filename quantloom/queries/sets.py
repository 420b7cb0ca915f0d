"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation, merge, planning
from ..operators.transition import portfolio_transition
from .inputs import PLAN_END, PLAN_START, Market
from .registry import query


@query("union_windows", """
SELECT symbol, date, open, high, low, close, adjusted_close, volume FROM o_downloaded
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY arrival DESC) = 1""", dates=["date"])
def union_windows(m: Market):
    return merge.union_windows(m.downloaded)


@query("date_sets", """
SELECT DISTINCT symbol, date, CASE WHEN p.close IS NULL THEN 'new' ELSE 'replaced' END AS kind
FROM o_downloaded d LEFT JOIN o_published p USING (symbol, date)""", dates=["date"])
def date_sets(m: Market):
    replaced = merge.replaced_dates(m.published, m.downloaded).withColumn("kind", F.lit("replaced"))
    return replaced.unionByName(
        merge.new_dates(m.published, m.downloaded).withColumn("kind", F.lit("new"))
    )


@query("missing_sessions", "SELECT symbol, session, reason FROM o_missing", dates=["session"])
def missing_sessions(m: Market):
    return planning.missing_sessions(m.held_dates, m.calendar, PLAN_START, PLAN_END)


@query("symbol_union", "SELECT as_of_date, symbol, position FROM o_move", dates=["as_of_date"])
def symbol_union(m: Market):
    return portfolio_transition(m.state[0], m.positions).select("as_of_date", "symbol", "position")


@query("date_closure", """
SELECT as_of_date, 'panel_only' AS side FROM
  (SELECT DISTINCT as_of_date FROM o_panel EXCEPT SELECT as_of_date FROM o_labels)
UNION ALL SELECT as_of_date, 'labels_only' FROM
  (SELECT as_of_date FROM o_labels EXCEPT SELECT as_of_date FROM o_panel)""", dates=["as_of_date"])
def date_closure(m: Market):
    return evaluation.date_closure(m.panel, m.labels)


@query("concat_labels", """
SELECT * FROM o_labels UNION ALL BY NAME
SELECT p.as_of_date, e.session AS end_date, p.symbol, p.factor_name, p.factor_version,
       CAST(4 AS BIGINT) AS horizon_sessions, b1.adjusted_close / b0.adjusted_close - 1 AS forward_return,
       b1.adjusted_close IS NOT NULL AND b0.adjusted_close IS NOT NULL AS is_available
FROM o_panel p JOIN o_cal e ON e.sid = p.sid + 4
LEFT JOIN o_bars b0 ON b0.symbol = p.symbol AND b0.date = p.as_of_date
LEFT JOIN o_bars b1 ON b1.symbol = p.symbol AND b1.date = e.session""", dates=["as_of_date", "end_date"])
def concat_labels(m: Market):
    from ..operators.labels import forward_returns

    return m.labels.unionByName(forward_returns(m.panel, m.stored_bars, m.calendar, 4))
