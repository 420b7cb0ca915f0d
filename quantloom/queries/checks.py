"""Contract checks on tables with defects in them; each returns its violations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import contracts, schedule
from ..session import durable
from .inputs import STUDY_END, STUDY_START, Market
from .registry import query

NONE = "CAST(NULL AS DOUBLE)"


def rules_sql(table: str, key: str, rules: dict[str, str | tuple[str, str]]) -> str:
    """One SELECT per rule over ``table``; a rule is a condition or a condition and its value."""
    parts = []
    for rule, test in rules.items():
        condition, value = test if isinstance(test, tuple) else (test, "NULL")
        parts.append(
            f"SELECT '{rule}' AS rule, {key} AS key, CAST({value} AS DOUBLE) AS value FROM {table} WHERE {condition}"
        )
    return "\nUNION ALL ".join(parts)


def repeats_sql(table: str, rule: str, *columns: str) -> str:
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return (
        f"SELECT '{rule}' AS rule, {key} AS key, CAST(count(*) AS DOUBLE) AS value FROM {table} "
        f"GROUP BY {', '.join(columns)} HAVING count(*) > 1"
    )


def both(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


DAY_SYMBOL = "CAST(as_of_date AS VARCHAR) || '|' || symbol"
SYMBOL_DAY = "symbol || '|' || CAST(date AS VARCHAR)"
VENUES = "('NASDAQ', 'NYSE', 'NYSE AMERICAN', 'NYSE ARCA', 'BATS', 'OTC')"


@query("universe_violations", both(
    rules_sql("o_norm", "symbol", {
        "symbol_empty": "symbol = ''",
        "symbol_too_long": ("length(symbol) > 10", "length(symbol)"),
        "symbol_malformed": "symbol <> '' AND length(symbol) <= 10 AND NOT regexp_full_match(symbol, '[A-Z0-9.\\-]+')",
        "name_empty": "name = ''", "exchange_empty": "exchange = ''",
        "exchange_unknown": f"exchange <> '' AND exchange NOT IN {VENUES}",
        "security_type_unsupported": "security_type <> 'common_stock'",
        "is_active_not_boolean": "active IS NULL",
    }),
    repeats_sql("(SELECT * FROM o_norm WHERE symbol <> '')", "symbol_repeated", "symbol"),
))
def universe_violations(m: Market):
    return contracts.universe_violations(m.normalized)


@query("bar_violations", both(
    rules_sql("""(SELECT *, date = min(date) OVER (PARTITION BY symbol) AS f FROM o_damaged)""", SYMBOL_DAY, {
        "adjusted_close_not_positive": ("adjusted_close <= 0", "adjusted_close"),
        "high_not_positive": ("high <= 0", "high"),
        "volume_negative": ("volume < 0", "volume"),
        "high_below_range": ("high < greatest(open, close, low)", "high"),
        "low_above_range": ("low > least(open, close, high)", "low"),
        "first_return_not_null": "f AND daily_return IS NOT NULL",
        "later_return_null": "NOT f AND daily_return IS NULL",
        "symbol_malformed": "NOT regexp_full_match(symbol, '[A-Z0-9.\\-]+')",
    }),
    repeats_sql("o_damaged", "date_not_increasing", "symbol", "date"),
))
def bar_violations(m: Market):
    return contracts.bar_violations(m.damaged)


BAD_PANEL = """
(SELECT as_of_date, CASE WHEN symbol = 'BRAND.6' THEN 'ELSE.6' ELSE symbol END AS symbol, factor_name,
        CASE WHEN symbol = 'BRAND.8' THEN '' ELSE factor_version END AS factor_version,
        CASE WHEN symbol = 'BRAND.10' THEN NULL ELSE is_eligible END AS is_eligible FROM o_panel
 UNION ALL SELECT as_of_date, symbol, factor_name, factor_version, is_eligible FROM o_panel WHERE symbol = 'BRAND.11')"""


@query("panel_violations", both(
    rules_sql(BAD_PANEL, DAY_SYMBOL, {
        "eligible_missing": "is_eligible IS NULL", "version_empty": "factor_version = ''",
        "symbol_outside_universe": "symbol NOT IN (SELECT symbol FROM o_pool)",
    }),
    repeats_sql(BAD_PANEL, "row_repeated", "as_of_date", "symbol", "factor_name"),
    f"""SELECT 'several_identities', CAST(as_of_date AS VARCHAR), count(DISTINCT (factor_name, factor_version)) FROM {BAD_PANEL}
        GROUP BY as_of_date HAVING count(DISTINCT (factor_name, factor_version)) > 1""",
    f"SELECT 'symbol_missing', {DAY_SYMBOL}, NULL FROM o_panel WHERE symbol = 'BRAND.6'",
))
def panel_violations(m: Market):
    symbol = F.col("symbol")
    bad = m.panel.select(
        "as_of_date", F.when(symbol == "BRAND.6", "ELSE.6").otherwise(symbol).alias("symbol"),
        "factor_name", "raw_value",
        F.when(symbol == "BRAND.8", "").otherwise(F.col("factor_version")).alias("factor_version"),
        F.when(symbol != "BRAND.10", F.col("is_eligible")).alias("is_eligible"),
    )
    extra = m.panel.where("symbol = 'BRAND.11'").select(*bad.columns)
    return contracts.panel_violations(bad.unionByName(extra), m.grid)


@query("result_columns", """
SELECT * FROM (VALUES ('column_forbidden', 'weight'), ('column_forbidden', 'turnover'), ('column_unexpected', 'note'), ('column_missing', 'rank'))
  v(rule, key) WHERE EXISTS (SELECT * FROM o_result)""")
def result_columns(m: Market):
    """A strategy result with columns of a later layer, an unknown one, and one too few: rows are not looked at before the columns are right."""
    bad = m.result.drop("rank").withColumns({"weight": F.lit(0.1), "turnover": F.lit(0.0), "note": F.lit("")})
    return contracts.strategy_violations(bad, m.grid).select("rule", "key")


@query("several_strategies", """
SELECT 'several_identities' AS rule, CAST(as_of_date AS VARCHAR) AS key, CAST(2 AS DOUBLE) AS value FROM o_result
WHERE year(as_of_date) = 2000 AND symbol = 'BRAND.4'
UNION ALL SELECT 'version_empty', CAST(as_of_date AS VARCHAR) || '|' || symbol, NULL FROM o_result WHERE year(as_of_date) = 2000 AND symbol = 'BRAND.4'""")
def several_strategies(m: Market):
    """One symbol's rows of a year carry another strategy version, an empty one."""
    other = (F.col("symbol") == "BRAND.4") & (F.year("as_of_date") == 2000)
    bad = m.result.withColumn("strategy_version", F.when(other, " ").otherwise(F.col("strategy_version")))
    return contracts.strategy_violations(bad, m.grid)


@query("context_violations", both(
    rules_sql("o_damaged", SYMBOL_DAY, {
        "bar_after_decision": "date > DATE '2001-01-15'",
        "symbol_outside_universe": "symbol NOT IN (SELECT symbol FROM o_pool)",
    }),
    repeats_sql("o_damaged", "bar_repeated", "symbol", "date"),
))
def context_violations(m: Market):
    return contracts.context_violations(m.damaged, m.pool, date(2001, 1, 15))


BAD_LABELS = """
(SELECT as_of_date, symbol, factor_name,
        CASE WHEN symbol = 'BRAND.3' THEN as_of_date ELSE end_date END AS end_date,
        CASE WHEN symbol = 'BRAND.5' THEN 0 ELSE horizon_sessions END AS horizon_sessions, forward_return,
        CASE WHEN symbol = 'BRAND.7' THEN NOT is_available ELSE is_available END AS is_available
 FROM o_labels WHERE symbol <> 'BRAND.9')"""


@query("label_violations", both(
    rules_sql(BAD_LABELS, DAY_SYMBOL, {
        "horizon_below_one": ("horizon_sessions < 1", "horizon_sessions"),
        "end_not_after_start": "end_date <= as_of_date",
        "available_without_return": "is_available AND NOT coalesce(isfinite(forward_return), FALSE)",
        "return_without_availability": ("NOT is_available AND isfinite(forward_return)", "forward_return"),
    }),
    f"""SELECT 'several_horizons', CAST(as_of_date AS VARCHAR), count(DISTINCT (end_date, horizon_sessions))
        FROM {BAD_LABELS} GROUP BY as_of_date HAVING count(DISTINCT (end_date, horizon_sessions)) > 1""",
    f"SELECT 'symbol_missing', {DAY_SYMBOL}, NULL FROM o_labels WHERE symbol = 'BRAND.9'",
))
def label_violations(m: Market):
    symbol = F.col("symbol")
    bad = (
        m.labels.where(symbol != "BRAND.9")
        .withColumn("end_date", F.when(symbol == "BRAND.3", F.col("as_of_date")).otherwise(F.col("end_date")))
        .withColumn("horizon_sessions", F.when(symbol == "BRAND.5", 0).otherwise(F.col("horizon_sessions")))
        .withColumn("is_available", F.when(symbol == "BRAND.7", ~F.col("is_available")).otherwise(F.col("is_available")))
    )
    return contracts.label_violations(bad, m.grid)


PRICES = """
(SELECT c.session AS as_of_date, e.session AS end_date, d.symbol, d.date FROM o_damaged d
 JOIN o_cal s ON s.session = d.date JOIN o_cal c ON c.sid = s.sid - s.sid % 10 + 4 JOIN o_cal e ON e.sid = c.sid + 4)"""


@query("price_window_violations", both(
    rules_sql(PRICES, "CAST(as_of_date AS VARCHAR) || '|' || symbol || '|' || CAST(date AS VARCHAR)", {
        "outside_window": "date NOT BETWEEN as_of_date AND end_date",
        "symbol_outside_universe": "symbol NOT IN (SELECT symbol FROM o_pool)",
    }),
    repeats_sql(PRICES, "price_repeated", "as_of_date", "symbol", "date"),
))
def price_window_violations(m: Market):
    """Every bar claimed by the label window of its block of ten sessions; half lie outside."""
    cal = m.calendar
    start = cal.select(F.col("session").alias("as_of_date"), F.col("sid").alias("c_sid"))
    end = cal.select(F.col("session").alias("end_date"), (F.col("sid") - 4).alias("c_sid"))
    prices = (
        m.damaged.join(cal, F.col("date") == F.col("session"))
        .withColumn("c_sid", F.col("sid") - F.pmod("sid", F.lit(10)) + 4)
        .join(start, "c_sid").join(end, "c_sid")
        .select("as_of_date", "end_date", "symbol", "date")
    )
    return contracts.price_window_violations(prices, m.pool)


BAD_RESULT = """
(SELECT as_of_date, symbol, strategy_name, CASE WHEN symbol = 'BRAND.2' THEN ord + 100 ELSE ord END AS ord,
        CASE WHEN symbol = 'BRAND.12' THEN CAST('inf' AS DOUBLE) ELSE score END AS score,
        CASE WHEN rank = 2 THEN 1 WHEN rank = 3 THEN 0 WHEN rank = 4 THEN NULL ELSE rank END AS rank, is_selected
 FROM o_result WHERE symbol <> 'BRAND.20')"""


@query("strategy_result_violations", both(
    rules_sql(BAD_RESULT, DAY_SYMBOL, {
        "score_not_finite": "isinf(score)", "rank_below_one": ("rank < 1", "rank"),
        "selected_without_score": "is_selected AND NOT coalesce(isfinite(score), FALSE)",
        "selected_without_rank": "is_selected AND rank IS NULL",
        "out_of_universe_order": ("ord > 100", "ord"),
    }),
    repeats_sql(f"(SELECT * FROM {BAD_RESULT} WHERE rank >= 1)", "rank_repeated", "as_of_date", "rank"),
    f"SELECT 'symbol_missing', {DAY_SYMBOL}, NULL FROM o_result WHERE symbol = 'BRAND.20'",
))
def strategy_result_violations(m: Market):
    symbol, rank = F.col("symbol"), F.col("rank")
    bad = (
        m.result.where(symbol != "BRAND.20")
        .withColumn("ord", F.when(symbol == "BRAND.2", F.col("ord") + 100).otherwise(F.col("ord")))
        .withColumn("score", F.when(symbol == "BRAND.12", float("inf")).otherwise(F.col("score")))
        .withColumn("rank", F.when(rank == 2, 1).when(rank == 3, 0).when(rank == 4, F.lit(None)).otherwise(rank))
    )
    return contracts.strategy_violations(bad, m.grid)


BAD_POS = """
(SELECT as_of_date, CASE WHEN symbol = 'BRAND.4' THEN 'CASH' ELSE symbol END AS symbol,
        CASE WHEN symbol = 'BRAND.6' THEN -0.5 ELSE weight END AS weight FROM o_pos
 UNION ALL SELECT as_of_date, symbol, weight FROM o_pos WHERE symbol = 'BRAND.13')"""
BAD_CASH = "(SELECT as_of_date, CASE WHEN day(as_of_date) = 1 THEN 1.5 ELSE cash_weight END AS cash_weight FROM o_cash)"


@query("portfolio_violations", both(
    rules_sql(BAD_POS, DAY_SYMBOL, {
        "weight_not_positive": ("weight <= 0", "weight"), "cash_as_symbol": "symbol = 'CASH'",
        "not_selected": "(as_of_date, symbol) NOT IN (SELECT (as_of_date, symbol) FROM o_sel)",
    }),
    rules_sql(BAD_CASH, "CAST(as_of_date AS VARCHAR)", {
        "cash_outside_share": ("cash_weight NOT BETWEEN 0 AND 1", "cash_weight"),
    }),
    repeats_sql(BAD_POS, "symbol_repeated", "as_of_date", "symbol"),
    f"""SELECT 'incomplete', CAST(as_of_date AS VARCHAR), NULL FROM {BAD_CASH}
        LEFT JOIN (SELECT as_of_date, sum(weight) AS w FROM {BAD_POS} GROUP BY as_of_date) USING (as_of_date)
        WHERE abs(coalesce(w, 0) + cash_weight - 1) > 1e-9""",
))
def portfolio_violations(m: Market):
    symbol = F.col("symbol")
    bad = m.positions.select(
        "as_of_date", F.when(symbol == "BRAND.4", "CASH").otherwise(symbol).alias("symbol"),
        F.when(symbol == "BRAND.6", -0.5).otherwise(F.col("weight")).alias("weight"),
    )
    extra = m.positions.where("symbol = 'BRAND.13'").select(*bad.columns)
    cash = m.cash.withColumn(
        "cash_weight", F.when(F.dayofmonth("as_of_date") == 1, 1.5).otherwise(F.col("cash_weight"))
    )
    return contracts.portfolio_violations(bad.unionByName(extra), cash, m.selected)


@query("state_violations", """
SELECT 'state_after_decision' AS rule, CAST(as_of_date AS VARCHAR) AS key, CAST(NULL AS DOUBLE) AS value
FROM o_cash WHERE day(as_of_date) > 25""")
def state_violations(m: Market):
    late = F.when(F.dayofmonth("as_of_date") > 25, F.date_add("as_of_date", 1)).otherwise(F.col("as_of_date"))
    return contracts.state_violations(m.cash.withColumn("state_date", late))


@query("constraint_violations", """
SELECT 'non_positive_score' AS rule, as_of_date, symbol FROM o_result WHERE is_selected AND score <= 0
UNION ALL SELECT 'infeasible_cap', as_of_date, NULL FROM o_sel GROUP BY as_of_date HAVING count(*) * 0.15 + 1e-12 < 1.0
""", dates=["as_of_date"])
def constraint_violations(m: Market):
    """A cap too small for five names to carry the whole account."""
    from ..operators.weights import weight_refusals

    return weight_refusals(m.selected, 0.0, 0.15)


BAD_MOVE = """
(SELECT as_of_date, symbol, position, CASE WHEN position = 1 THEN current_weight + 0.1 ELSE current_weight END AS current_weight,
        target_weight, weight_change FROM o_move WHERE position <> 2
 UNION ALL SELECT as_of_date, 'NEW.1', 50, 0.0, 0.0, 0.0 FROM o_cash)"""


@query("transition_violations", both(
    rules_sql("o_move", DAY_SYMBOL, {
        "row_missing": "position = 2",
        "current_disagrees": "position = 1", "change_disagrees": "position = 1",
    }),
    "SELECT 'row_unexpected', CAST(as_of_date AS VARCHAR) || '|NEW.1', NULL FROM o_cash",
))
def transition_violations(m: Market):
    moved = F.when(F.col("position") == 1, F.col("current_weight") + 0.1).otherwise(F.col("current_weight"))
    bad = m.transition.where("position <> 2").withColumn("current_weight", moved)
    zero = F.lit(0.0)
    extra = m.cash.select(
        "as_of_date", F.lit("NEW.1").alias("symbol"), zero.alias("current_weight"), zero.alias("target_weight"),
        zero.alias("weight_change"), F.lit(50).alias("position"),
    )
    return contracts.transition_violations(bad.unionByName(extra), m.state[0], m.positions)


BAD_ORDERS = """
(SELECT CASE WHEN symbol = 'BRAND.5' THEN ' ' || order_id WHEN symbol IN ('BRAND.7', 'BRAND.8') THEN 'same' ELSE order_id END AS order_id,
        decision_date, CASE WHEN symbol = 'BRAND.9' THEN decision_date ELSE scheduled_fill_date END AS scheduled_fill_date,
        CASE WHEN symbol = 'BRAND.10' THEN 'BRAND.11' ELSE symbol END AS symbol,
        CASE WHEN symbol = 'BRAND.12' THEN 'hold' ELSE side END AS side,
        CASE WHEN symbol = 'BRAND.13' THEN 0.0 ELSE quantity END AS quantity FROM o_orders)"""


def _bad_orders(m: Market):
    symbol = F.col("symbol")
    return m.orders.select(
        F.when(symbol == "BRAND.5", F.concat(F.lit(" "), "order_id"))
        .when(symbol.isin("BRAND.7", "BRAND.8"), "same").otherwise(F.col("order_id")).alias("order_id"),
        "decision_date",
        F.when(symbol == "BRAND.9", F.col("decision_date")).otherwise(F.col("scheduled_fill_date"))
        .alias("scheduled_fill_date"),
        F.when(symbol == "BRAND.10", "BRAND.11").otherwise(symbol).alias("symbol"),
        F.when(symbol == "BRAND.12", "hold").otherwise(F.col("side")).alias("side"),
        F.when(symbol == "BRAND.13", 0.0).otherwise(F.col("quantity")).alias("quantity"),
    )


@query("order_violations", both(
    rules_sql(BAD_ORDERS, "order_id", {
        "id_padded": "order_id <> trim(order_id)", "side_unknown": "side NOT IN ('BUY', 'SELL')",
        "quantity_not_positive": ("quantity <= 0", "quantity"),
        "fill_not_after_decision": "scheduled_fill_date <= decision_date",
    }),
    repeats_sql(BAD_ORDERS, "id_repeated", "order_id"),
    repeats_sql(BAD_ORDERS, "symbol_ordered_twice", "decision_date", "symbol"),
    rules_sql(f"(SELECT * FROM {BAD_ORDERS} LEFT JOIN (SELECT * FROM o_events WHERE year(decision_date) < 2001) USING (decision_date))",
              "order_id", {
        "decision_without_event": "execution_date IS NULL",
        "not_the_event_session": "execution_date <> scheduled_fill_date",
    }),
))
def order_violations(m: Market):
    return contracts.order_violations(_bad_orders(m), m.events.where(F.year("decision_date") < 2001))


BAD_FILLS = """
(SELECT CASE WHEN symbol = 'BRAND.3' THEN order_id || '?' ELSE order_id END AS order_id,
        CASE WHEN symbol = 'BRAND.5' THEN fill_date + 1 ELSE fill_date END AS fill_date,
        CASE WHEN symbol = 'BRAND.7' THEN 1e308 ELSE fill_price END AS fill_price,
        CASE WHEN symbol = 'BRAND.9' THEN 0.5 ELSE quantity END AS quantity,
        CASE WHEN symbol = 'BRAND.11' THEN -1.0 ELSE transaction_cost END AS transaction_cost FROM o_fills
 UNION ALL SELECT order_id, fill_date, fill_price, quantity, transaction_cost FROM o_fills WHERE symbol = 'BRAND.13')"""


@query("fill_violations", both(
    rules_sql(f"(SELECT f.*, o.scheduled_fill_date AS due, o.quantity AS ordered FROM {BAD_FILLS} f LEFT JOIN o_orders o USING (order_id))",
              "order_id", {
        "order_unknown": "ordered IS NULL", "wrong_session": "fill_date <> due",
        "partial_fill": ("quantity <> ordered", "quantity"),
        "cost_negative": ("transaction_cost < 0", "transaction_cost"),
        "notional_not_finite": "fill_price = 1e308 AND quantity > 1.8",
        "cash_not_finite": "fill_price = 1e308 AND quantity > 1.8",
        "outside_window": "fill_date NOT BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'",
    }),
    repeats_sql(BAD_FILLS, "order_filled_twice", "order_id"),
))
def fill_violations(m: Market):
    symbol = F.col("symbol")
    bad = m.fills.select(
        F.when(symbol == "BRAND.3", F.concat("order_id", F.lit("?"))).otherwise(F.col("order_id")).alias("order_id"),
        F.when(symbol == "BRAND.5", F.date_add("fill_date", 1)).otherwise(F.col("fill_date")).alias("fill_date"),
        F.when(symbol == "BRAND.7", 1e308).otherwise(F.col("fill_price")).alias("fill_price"),
        F.when(symbol == "BRAND.9", 0.5).otherwise(F.col("quantity")).alias("quantity"),
        F.when(symbol == "BRAND.11", -1.0).otherwise(F.col("transaction_cost")).alias("transaction_cost"),
    )
    extra = m.fills.where("symbol = 'BRAND.13'").select(*bad.columns)
    return contracts.fill_violations(bad.unionByName(extra), m.orders, STUDY_START, STUDY_END)


@query("history_order_violations", """
SELECT 'out_of_order' AS rule, order_id AS key, CAST(position AS DOUBLE) AS value FROM (
  SELECT order_id, position, row_number() OVER (PARTITION BY fill_date ORDER BY order_id) AS a,
         row_number() OVER (PARTITION BY fill_date ORDER BY position) AS b
  FROM (SELECT f.order_id, f.fill_date, -p.ord AS position FROM o_fills f JOIN o_pool p USING (symbol))) WHERE a <> b""")
def history_order_violations(m: Market):
    """Fills listed in reverse universe order against their promised id order."""
    listed = m.fills.join(m.pool, "symbol").withColumn("position", -F.col("ord"))
    return contracts.history_order_violations(listed, "order_id", "fill_date", "order_id")


VALUES = """
(SELECT as_of_date, CASE WHEN day(as_of_date) = 3 THEN -0.05 ELSE cash_weight END AS cash,
        CASE WHEN day(as_of_date) = 5 THEN 2.0 ELSE 1.0 - cash_weight END AS market_value, 1.0 AS nav FROM o_cash
 UNION ALL SELECT as_of_date, cash_weight, 1.0 - cash_weight, 1.0 FROM o_cash WHERE day(as_of_date) = 7)"""


def _valuations(m: Market):
    day, cash = F.dayofmonth("as_of_date"), F.col("cash_weight")
    values = m.cash.select(
        "as_of_date", F.when(day == 3, -0.05).otherwise(cash).alias("cash"),
        F.when(day == 5, 2.0).otherwise(1.0 - cash).alias("market_value"), F.lit(1.0).alias("nav"),
    )
    twice = m.cash.where(day == 7).select(
        "as_of_date", cash.alias("cash"), (1.0 - cash).alias("market_value"), F.lit(1.0).alias("nav")
    )
    return values.unionByName(twice)


@query("valuation_violations", both(
    rules_sql(VALUES, "CAST(as_of_date AS VARCHAR)", {
        "nav_disagrees": "abs(nav - (cash + market_value)) > 1e-9", "cash_negative": ("cash < 0", "cash"),
        "outside_window": "as_of_date NOT BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'",
    }),
    repeats_sql(VALUES, "date_repeated", "as_of_date"),
))
def valuation_violations(m: Market):
    return contracts.valuation_violations(_valuations(m), STUDY_START, STUDY_END)


@query("closing_violations", """
SELECT CASE WHEN as_of_date = (SELECT max(as_of_date) FROM o_cash) THEN 'cash_disagrees' ELSE 'not_the_last_session' END AS rule,
       CAST(as_of_date AS VARCHAR) AS key, CAST(NULL AS DOUBLE) AS value FROM o_cash""")
def closing_violations(m: Market):
    """Every date's state offered as the closing one, with a little cash too much."""
    values = m.cash.select("as_of_date", F.col("cash_weight").alias("cash"))
    return contracts.closing_violations(values, values.withColumn("cash", F.col("cash") + 1e-6))


LIVE = """
(SELECT symbol, date FROM o_std WHERE symbol <> 'BRAND.2' OR year(date) < 2001
 UNION ALL SELECT symbol, date FROM o_std WHERE symbol = 'BRAND.4' AND year(date) = 1999
 UNION ALL SELECT 'EXTRA', date FROM o_std WHERE symbol = 'BRAND.5')"""


@query("publish_confirm", both(
    f"""SELECT 'row_count_differs' AS rule, symbol AS key, CAST(coalesce(l.n, 0) AS DOUBLE) AS value
        FROM (SELECT symbol, count(*) AS n FROM o_std GROUP BY symbol) s
        FULL JOIN (SELECT symbol, count(*) AS n FROM {LIVE} GROUP BY symbol) l USING (symbol)
        WHERE coalesce(s.n, 0) <> coalesce(l.n, 0)""",
    "SELECT 'symbol_unexpected', 'EXTRA', NULL",
    repeats_sql(LIVE, "row_repeated", "symbol", "date"),
))
def publish_confirm(m: Market):
    live = m.standard.where("symbol <> 'BRAND.2' or year(date) < 2001")
    twice = m.standard.where("symbol = 'BRAND.4' and year(date) = 1999")
    extra = m.standard.where("symbol = 'BRAND.5'").withColumn("symbol", F.lit("EXTRA"))
    return contracts.publish_violations(m.standard, live.unionByName(twice).unionByName(extra))


@query("ic_report_consistency", """
SELECT 'count_disagrees' AS rule, factor_name || '|' || factor_version || '|' || horizon_sessions AS key,
       CAST(count(ic) + 1 AS DOUBLE) AS value FROM o_ic GROUP BY factor_name, factor_version, horizon_sessions
UNION ALL
SELECT 'icir_disagrees', factor_name || '|' || factor_version || '|' || horizon_sessions, NULL
FROM o_ic GROUP BY factor_name, factor_version, horizon_sessions HAVING count(ic) > 1""")
def ic_report_consistency(m: Market):
    """A report whose count and ratio are wrong."""
    from ..operators.evaluation import ic_summary

    ics = durable(m.ics, "ics")
    reported = ic_summary(ics).withColumn("valid_ic_count", F.col("valid_ic_count") + 1).withColumn(
        "icir", F.col("icir") + 0.5
    )
    return contracts.ic_report_consistency(ics, reported)


@query("quantile_block_consistency", """
SELECT 'groups_incomplete' AS rule, CAST(as_of_date AS VARCHAR) AS key, CAST(4 AS DOUBLE) AS value
FROM o_spread WHERE day(as_of_date) = 3
UNION ALL SELECT 'members_disagree', CAST(as_of_date AS VARCHAR), sum(member_count) FROM o_obs
WHERE day(as_of_date) = 3 AND quantile <> 5 GROUP BY as_of_date HAVING sum(member_count) <> max(paired_count)
UNION ALL SELECT 'coverage_disagrees', CAST(as_of_date AS VARCHAR), NULL FROM o_obs
WHERE day(as_of_date) = 3 AND quantile <> 5 GROUP BY as_of_date HAVING sum(member_count) <> max(paired_count)
UNION ALL SELECT 'top_mean_forward_return_disagrees', CAST(as_of_date AS VARCHAR), NULL FROM o_spread
WHERE day(as_of_date) = 3 AND top_mean_forward_return IS NOT NULL
UNION ALL SELECT 'top_minus_bottom_disagrees', CAST(as_of_date AS VARCHAR), NULL FROM o_spread
WHERE day(as_of_date) = 3 AND top_minus_bottom IS NOT NULL""")
def quantile_block_consistency(m: Market):
    """The top group is lost on the third of a month; the spreads still know it."""
    from ..operators.evaluation import quantile_spread

    groups = durable(m.quantiles, "quantiles")
    kept = groups.where((F.dayofmonth("as_of_date") != 3) | (F.col("quantile") != 5))
    return contracts.quantile_block_consistency(kept, quantile_spread(groups))


@query("schedule_violations", """
SELECT 'not_a_session' AS rule, CAST(decision_date + 2 AS VARCHAR) AS key, CAST(NULL AS DOUBLE) AS value
FROM o_weekly WHERE month(decision_date) = 5 AND decision_date + 2 NOT IN (SELECT session FROM o_bdays)
UNION ALL SELECT 'decision_missing', CAST(decision_date AS VARCHAR), NULL FROM o_weekly WHERE month(decision_date) = 5
UNION ALL SELECT 'decision_unexpected', CAST(decision_date + 2 AS VARCHAR), NULL FROM o_weekly
WHERE month(decision_date) = 5 AND decision_date + 2 NOT IN (SELECT decision_date FROM o_weekly)
UNION ALL SELECT 'decision_repeated', CAST(d AS VARCHAR), count(*) FROM
  (SELECT CASE WHEN month(decision_date) = 5 THEN decision_date + 2 ELSE decision_date END AS d FROM o_weekly)
  GROUP BY d HAVING count(*) > 1
UNION ALL SELECT 'event_without_decision', CAST(decision_date AS VARCHAR), NULL FROM o_rebalance
WHERE month(decision_date) = 5 AND decision_date NOT IN (SELECT decision_date + 2 FROM o_weekly WHERE month(decision_date) = 5)
UNION ALL SELECT 'execution_disagrees', CAST(decision_date AS VARCHAR), NULL FROM o_rebalance WHERE month(decision_date) = 7
UNION ALL SELECT 'event_missing', CAST(decision_date AS VARCHAR), NULL FROM o_rebalance WHERE month(decision_date) = 9
""")
def schedule_violations(m: Market):
    """May decisions moved two days, July executions a day late, September events lost."""
    cal, day = m.business_days, F.col("decision_date")
    rule_dates = durable(schedule.weekly_schedule(cal, STUDY_START, STUDY_END), "rule-dates")
    rule_events = durable(schedule.with_execution(rule_dates, cal, STUDY_END, 2).where("execution_date is not null"), "rule-events")
    decisions = rule_dates.select(F.when(F.month(day) == 5, F.date_add(day, 2)).otherwise(day).alias("decision_date"))
    late = F.when(F.month(day) == 7, F.date_add("execution_date", 1)).otherwise(F.col("execution_date"))
    events = rule_events.where(F.month(day) != 9).withColumn("execution_date", late)
    return contracts.schedule_violations(decisions, rule_dates, events, rule_events, cal, STUDY_START, STUDY_END)
