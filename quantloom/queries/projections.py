"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import usable_price
from ..operators import bars as bar_ops
from ..operators.evaluation import usable_pairs as keep_usable
from ..sources import universe
from .inputs import Market
from .registry import query

DERIVE = """
SELECT *, adjusted_close / lag(adjusted_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS daily_return,
       close * volume AS dollar_volume FROM """


@query("standardize_bars", DERIVE + """
(SELECT * FROM o_parsed WHERE date IS NOT NULL AND regexp_full_match(symbol, '[A-Z0-9.\\-]+'))""", dates=["date"])
def standardize_bars(m: Market):
    return bar_ops.standardize_bars(m.raw, strict=False)


@query("raw_violations", """
SELECT 'unparseable_date' AS rule, symbol, count(*) AS row_count FROM o_parsed WHERE date IS NULL GROUP BY symbol
UNION ALL SELECT 'malformed_symbol', symbol, count(*) FROM o_parsed
WHERE NOT regexp_full_match(symbol, '[A-Z0-9.\\-]+') GROUP BY symbol""")
def raw_violations(m: Market):
    return bar_ops.raw_violations(bar_ops.parse_raw(m.raw))


@query("derive_features", DERIVE + "o_bars", dates=["date"])
def derive_features(m: Market):
    return bar_ops.derive_features(m.bars)


@query("usable_pairs", """
SELECT as_of_date, symbol, raw_value, forward_return FROM o_use""", dates=["as_of_date"])
def usable_pairs(m: Market):
    return keep_usable(m.pairs).select("as_of_date", "symbol", "raw_value", "forward_return")


@query("usable_price", """
SELECT date, lower(symbol) AS ticker, CASE WHEN adjusted_close > 0 AND isfinite(adjusted_close) THEN adjusted_close END AS price
FROM o_damaged""", dates=["date"])
def usable(m: Market):
    return m.damaged.select("date", F.lower("symbol").alias("ticker"), usable_price("adjusted_close").alias("price"))


WANTED = "(SELECT DISTINCT 'S' || s_suppkey AS symbol FROM supplier)"


def _requested(m: Market):
    """Every supplier, spelled loosely."""
    return m.table("supplier").select(F.concat(F.lit(" s"), F.col("s_suppkey").cast("string")).alias("symbol"))


@query("select_universe_entries", f"""
SELECT symbol, name, exchange, line FROM o_norm WHERE active AND symbol IN (SELECT symbol FROM {WANTED})""")
def select_universe_entries(m: Market):
    """Requested active entries; ``line`` keeps the file order."""
    return universe.select_entries(m.normalized, _requested(m)).select("symbol", "name", "exchange", "line")


@query("unknown_universe_symbols", f"""
SELECT symbol FROM (SELECT symbol FROM {WANTED} UNION SELECT upper(n_name) FROM nation) w WHERE symbol NOT IN (SELECT symbol FROM o_norm)""")
def unknown_universe_symbols(m: Market):
    """A name that is inactive is known: every entry counts. The names of nations are in no entry."""
    names = m.table("nation").select(F.col("n_name").alias("symbol"))
    return universe.unknown_symbols(m.normalized, _requested(m).unionByName(names))


@query("normalize_universe", "SELECT * FROM o_norm")
def normalize_universe(m: Market):
    return m.normalized


@query("static_snapshot", """
SELECT session AS as_of_date, symbol, row_number() OVER (PARTITION BY session ORDER BY symbol) AS ord, 'seed' AS source
FROM (SELECT DISTINCT symbol FROM o_norm WHERE active AND symbol <> '')
CROSS JOIN (SELECT DISTINCT CAST(date_trunc('month', session) AS DATE) AS session FROM o_cal)
""", dates=["as_of_date"])
def static_snapshot(m: Market):
    """The active pool of the large security master on every month start."""
    months = m.calendar.select(F.trunc("session", "month").alias("as_of_date"))
    return universe.static_snapshot(m.normalized.where("symbol <> ''"), months, "seed")


@query("selected_scores", "SELECT * FROM o_sel", dates=["as_of_date"])
def selected_scores(m: Market):
    return m.selected


@query("ineligible_nulling", """
SELECT p.as_of_date, p.symbol, p.raw_value, p.is_eligible, r.score, r.rank, r.is_selected
FROM o_panel p JOIN o_result r USING (as_of_date, symbol) WHERE NOT p.is_eligible""", dates=["as_of_date"])
def ineligible_nulling(m: Market):
    off = m.stored_panel.where("not is_eligible").select("as_of_date", "symbol", "raw_value", "is_eligible")
    return off.join(m.result.select("as_of_date", "symbol", "score", "rank", "is_selected"), ["as_of_date", "symbol"])
