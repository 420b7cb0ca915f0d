"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar, evaluation, execution, merge, selection
from ..operators.panel import dense_grid
from ..session import scratch_path
from ..sources.panels import stored_panels, write_panels
from ..sources.universe import outside_universe, without_rows
from .inputs import HORIZON, Market
from .registry import query


@query("merge_bars", "SELECT * FROM o_merged", dates=["date"])
def merge_bars(m: Market):
    return merge.merge_bars(m.published, m.downloaded)


@query("forward_returns", "SELECT * FROM o_labels", dates=["as_of_date", "end_date"])
def forward_returns(m: Market):
    return m.labels


@query("pair_panels_labels", "SELECT * FROM o_pairs", dates=["as_of_date", "end_date"])
def pair_panels_labels(m: Market):
    return evaluation.pair(m.labelled_panel, m.labels)


@query("pair_violations", """
SELECT CASE WHEN l.symbol IS NULL THEN 'missing_label' WHEN p.symbol IS NULL THEN 'label_without_panel'
            ELSE 'identity_mismatch' END AS rule, as_of_date, symbol
FROM (SELECT * FROM o_panel WHERE symbol <> 'BRAND.9') p
FULL JOIN (SELECT * REPLACE (CASE WHEN symbol = 'BRAND.4' THEN '2.0.0' ELSE factor_version END AS factor_version)
           FROM o_labels) l USING (as_of_date, symbol)
WHERE l.symbol IS NULL OR p.symbol IS NULL OR p.factor_version <> l.factor_version""", dates=["as_of_date"])
def pair_violations(m: Market):
    """Dates without labels, a symbol without panel rows and a foreign version."""
    odd = F.when(F.col("symbol") == "BRAND.4", "2.0.0").otherwise(F.col("factor_version"))
    return evaluation.pair_violations(
        m.panel.where("symbol <> 'BRAND.9'"), m.labels.withColumn("factor_version", odd)
    )


@query("portfolio_transition", "SELECT * FROM o_move", dates=["as_of_date"],
       rounded=["current_weight", "target_weight", "weight_change"])
def portfolio_transition(m: Market):
    return m.transition


@query("fill_orders", "SELECT * FROM o_fills", dates=["decision_date", "scheduled_fill_date", "fill_date"],
       rounded=["quantity"], money=["gross_notional", "cash_change"])
def fill_orders(m: Market):
    return m.fills


@query("unpriced_orders", """
SELECT o.order_id, o.symbol, o.side FROM o_orders o
LEFT JOIN o_bars b ON b.symbol = o.symbol AND b.date = o.scheduled_fill_date AND dayofyear(b.date) % 7 <> 3 WHERE b.open IS NULL""")
def unpriced_orders(m: Market):
    """Only the busier weeks are taken to have had an auction."""
    opens = m.stored_bars.where("dayofyear(date) % 7 <> 3").select("date", "symbol", "open")
    return execution.unpriced_orders(m.orders, opens).select("order_id", "symbol", "side")


@query("dense_cross_section", "SELECT as_of_date, symbol, ord FROM o_grid", dates=["as_of_date"])
def dense_cross_section(m: Market):
    return dense_grid(m.pool, m.dates)


SOME = "(SELECT DISTINCT upper(replace(p_brand, '#', '.')) AS symbol FROM part WHERE p_size = 50)"


def _some(m: Market):
    """Brands that make a part of the largest size."""
    symbol = F.upper(F.replace("p_brand", F.lit("#"), F.lit("."))).alias("symbol")
    return m.table("part").where("p_size = 50").select(symbol).distinct()


@query("universe_semi", f"SELECT date, symbol, close FROM o_bars WHERE symbol IN {SOME}", dates=["date"])
def universe_semi(m: Market):
    return m.bars.join(_some(m), "symbol", "left_semi").select("date", "symbol", "close")


@query("universe_anti", f"""
SELECT 'outside_universe' AS side, symbol, count(*) AS row_count FROM o_bars WHERE symbol NOT IN {SOME} GROUP BY symbol
UNION ALL SELECT 'without_rows', symbol, 0 FROM (SELECT symbol FROM {SOME} UNION SELECT upper(replace(s_name, '#', '.')) FROM supplier)
WHERE symbol NOT IN (SELECT symbol FROM o_bars)""")
def universe_anti(m: Market):
    outside = outside_universe(m.stored_bars, _some(m)).groupBy("symbol").agg(F.count("*").alias("row_count"))
    # suppliers are names that no bar has
    names = m.table("supplier").select(F.upper(F.replace("s_name", F.lit("#"), F.lit("."))).alias("symbol"))
    absent = without_rows(_some(m).select("symbol").unionByName(names).distinct(), m.stored_bars)
    return outside.select(F.lit("outside_universe").alias("side"), "symbol", "row_count").unionByName(
        absent.select(F.lit("without_rows").alias("side"), "symbol", F.lit(0).cast("bigint").alias("row_count"))
    )


def _requirements(m: Market, *versions: str):
    return m.spark.createDataFrame(
        [("momentum_12_1", v) for v in versions], "factor_name string, factor_version string"
    )


@query("context_panels", "SELECT as_of_date, symbol, factor_version, raw_value FROM o_panel", dates=["as_of_date"])
def context_panels(m: Market):
    """Only the exact version is taken from a store that holds two."""
    root = scratch_path(m.spark, "panels")
    for version in ("1.0.0", "2.0.0"):
        write_panels(m.panel.withColumn("factor_version", F.lit(version)), root)
    return selection.context_panels(stored_panels(m.spark, root), _requirements(m, "1.0.0")).select(
        "as_of_date", "symbol", "factor_version", "raw_value"
    )


@query("missing_panels", "SELECT session AS as_of_date, 'momentum_12_1' AS factor_name, '3.0.0' AS factor_version FROM o_cal",
       dates=["as_of_date"])
def missing_panels(m: Market):
    return selection.missing_panels(m.panel, _requirements(m, "1.0.0", "3.0.0"), m.dates)


@query("session_offset", """
SELECT o_orderkey, c.session AS decision, e.session AS settled FROM orders
JOIN o_bdays c ON c.session = CAST(o_orderdate AS DATE) LEFT JOIN o_bdays e ON e.sid = c.sid + 3
""", dates=["decision", "settled"])
def session_offset(m: Market):
    """Order dates that are sessions, with the third session after each."""
    orders = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("decision"))
    kept = calendar.keep_sessions(orders, m.business_days, "decision")
    return calendar.session_offset(kept, m.business_days, "decision", 3, "settled")


@query("prev_session_or_same", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, session, sid FROM orders
ASOF LEFT JOIN o_bdays ON CAST(o_orderdate AS DATE) >= session""", dates=["day", "session"])
def prev_session_or_same(m: Market):
    orders = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    latest = orders.agg(F.max("day")).scalar()
    return calendar.session_on_or_before(orders, m.business_days, "day", latest)


@query("label_sessions", f"""
SELECT a.session AS as_of_date, b.session AS end_date FROM o_cal a JOIN o_cal b ON b.sid = a.sid + {HORIZON}
""", dates=["as_of_date", "end_date"])
def label_sessions(m: Market):
    from ..operators.labels import label_sessions as ends

    return ends(m.calendar, HORIZON)


@query("unlabelled_dates", f"""
SELECT session AS as_of_date FROM o_cal WHERE sid + {HORIZON} > (SELECT max(sid) FROM o_cal)""", dates=["as_of_date"])
def unlabelled_dates(m: Market):
    from ..operators.labels import unlabelled_dates as refused

    return refused(m.panel, m.calendar, HORIZON)
