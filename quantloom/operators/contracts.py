"""Data contracts as violation tables ``(rule, key, value)``; no rows means the contract holds.

Row rules are one projection, key rules one aggregation. All problems are reported, none
stops at the first.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    agrees, bool_word, is_finite, is_non_negative, is_positive, valid_name, valid_symbol,
)
from ..schemas import (
    EXCHANGES, FORBIDDEN_RESULT_COLUMNS, LABEL_COLUMNS, MAX_SYMBOL_LENGTH, MIN_UNIVERSE_SIZE, NAV_TOLERANCE, ORDER_SIDES, PANEL,
    PRICE_COLUMNS, RESULT_COLUMNS, SECURITY_TYPES, SUMMARY_TOLERANCE, WEIGHT_TOLERANCE,
)
from .evaluation import ic_summary, quantile_spread

def _shown(value: Column | None) -> Column:
    return (F.lit(None) if value is None else value).cast("double")


def _key(*columns) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])


def row_rules(df: DataFrame, key: Column, rules: dict[str, Column | tuple[Column, Column]]) -> DataFrame:
    """Violations of per-row rules; a rule is a condition, or a condition and the value to show."""
    found = []
    for rule, test in rules.items():
        broken, value = test if isinstance(test, tuple) else (test, None)
        found.append(
            F.when(
                F.coalesce(broken, F.lit(False)),
                F.struct(F.lit(rule).alias("rule"), key.alias("key"), _shown(value).alias("value")),
            )
        )
    return df.select(F.inline(F.array_compact(F.array(*found))))


def repeated(df: DataFrame, rule: str, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.lit(rule).alias("rule"), _key(*columns).alias("key"), F.col("copies").cast("double").alias("value"))
    )


def flagged(df: DataFrame, rule: str, key: Column, value: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.alias("key"), _shown(value).alias("value"))


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def column_violations(df: DataFrame, wanted: list[str], barred: list[str] | None = None, optional: tuple[str, ...] = ("ord",)) -> DataFrame:
    """A closed schema: every wanted column, no other but ``optional`` ones, and ``barred`` ones named as such."""
    found = [("column_missing", c) for c in wanted if c not in df.columns]
    for column in df.columns:
        if column in (barred or []):
            found.append(("column_forbidden", column))
        elif column not in [*wanted, *optional]:
            found.append(("column_unexpected", column))
    return df.sparkSession.createDataFrame([(rule, column, None) for rule, column in found], "rule string, key string, value double")


def _lacks(df: DataFrame, wanted: list[str]) -> bool:
    """Rules on rows cannot be asked where columns are missing."""
    return any(c not in df.columns for c in wanted)


def _identities(df: DataFrame, *names: str) -> DataFrame:
    """Dates whose rows carry more than one identity."""
    several = df.groupBy("as_of_date").agg(F.count_distinct(*[F.coalesce(n, F.lit("")) for n in names]).alias("n")).where("n > 1")
    return flagged(several, "several_identities", _key("as_of_date"), F.col("n"))


def universe_violations(normalized: DataFrame, minimum: int = MIN_UNIVERSE_SIZE) -> DataFrame:
    """Rules of a normalized security master."""
    symbol, empty = F.col("symbol"), F.col("symbol") == ""
    rows = row_rules(normalized, symbol, {
        "symbol_empty": empty,
        "symbol_too_long": (F.length(symbol) > MAX_SYMBOL_LENGTH, F.length(symbol)),
        "symbol_malformed": ~empty & (F.length(symbol) <= MAX_SYMBOL_LENGTH) & ~valid_symbol("symbol", exact=False),
        "name_empty": F.col("name") == "",
        "exchange_empty": F.col("exchange") == "",
        "exchange_unknown": (F.col("exchange") != "") & ~F.col("exchange").isin(EXCHANGES),
        "security_type_empty": F.col("security_type") == "",
        "security_type_unsupported": (F.col("security_type") != "") & ~F.col("security_type").isin(SECURITY_TYPES),
        "is_active_not_boolean": bool_word("is_active").isNull(),
    })
    size = normalized.agg(F.count("*").alias("n"))
    small = flagged(
        size.where(F.col("n") < minimum),
        "universe_too_small", F.lit("universe"), F.col("n"),
    )
    return union_all(rows, repeated(normalized.where(~empty), "symbol_repeated", "symbol"), small)


def bar_violations(bars: DataFrame) -> DataFrame:
    """Value rules of standard bars, plus an empty table being a failure."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    # an aggregate, not a window: rows of one symbol are unbounded while copies are unchecked
    opening = bars.groupBy("symbol").agg(F.min("date").alias("first_date"))
    marked = bars.join(opening, "symbol", "left").withColumn("is_first", F.col("date") == F.col("first_date"))
    rules = {f"{p}_not_positive": (~is_positive(p), F.col(p)) for p in PRICE_COLUMNS}
    rows = row_rules(marked, _key("symbol", "date"), {
        **rules,
        "volume_negative": (F.coalesce(F.col("volume") < 0, F.lit(True)), F.col("volume")),
        "dollar_volume_negative": (~is_non_negative("dollar_volume"), F.col("dollar_volume")),
        "high_below_range": (h < F.greatest(o, c, lo), h),
        "low_above_range": (lo > F.least(o, c, h), lo),
        "first_return_not_null": F.col("is_first") & F.col("daily_return").isNotNull(),
        "later_return_null": ~F.col("is_first") & F.col("daily_return").isNull(),
        "symbol_malformed": ~valid_symbol("symbol", exact=False),
        "date_missing": F.col("date").isNull(),
    })
    empty = bars.agg(F.count("*").alias("n")).where("n = 0")
    return union_all(
        rows, repeated(bars, "date_not_increasing", "symbol", "date"),
        flagged(empty, "dataset_empty", F.lit("bars")),
    )


def panel_violations(panel: DataFrame, grid: DataFrame) -> DataFrame:
    """A panel has the panel's columns and no others, and covers exactly the ``(as_of_date, symbol)`` grid, once, under one identity."""
    columns, day_symbol = column_violations(panel, PANEL.fieldNames()), ["as_of_date", "symbol"]
    if _lacks(panel, PANEL.fieldNames()):
        return columns
    rows = row_rules(panel, _key(*day_symbol), {
        "symbol_malformed": ~valid_symbol("symbol", exact=False),
        "eligible_missing": F.col("is_eligible").isNull(),
        "name_malformed": ~valid_name("factor_name", exact=False),
        "version_empty": F.coalesce(F.trim("factor_version") == "", F.lit(True)),
    })
    return union_all(
        rows, columns,
        repeated(panel, "row_repeated", "as_of_date", "symbol", "factor_name"),
        _identities(panel, "factor_name", "factor_version"),
        flagged(grid.join(panel, day_symbol, "left_anti"), "symbol_missing", _key(*day_symbol)),
        flagged(panel.join(grid, day_symbol, "left_anti"), "symbol_outside_universe", _key(*day_symbol)),
    )


def context_violations(bars: DataFrame, universe: DataFrame, as_of: date) -> DataFrame:
    """Bars a factor may see: none after the decision, all in the universe, no copies."""
    key = _key("symbol", "date")
    return union_all(
        flagged(bars.where(F.col("date") > F.lit(as_of)), "bar_after_decision", key),
        flagged(bars.join(universe, "symbol", "left_anti"), "symbol_outside_universe", key),
        repeated(bars, "bar_repeated", "symbol", "date"),
    )


def label_violations(labels: DataFrame, grid: DataFrame) -> DataFrame:
    """Panel rules for labels, one factor and one horizon a date, and availability exactly where a return exists."""
    columns, day_symbol = column_violations(labels, LABEL_COLUMNS), ["as_of_date", "symbol"]
    if _lacks(labels, LABEL_COLUMNS):
        return columns
    rows = row_rules(labels, _key(*day_symbol), {
        "symbol_malformed": ~valid_symbol("symbol", exact=False),
        "name_malformed": ~valid_name("factor_name", exact=False),
        "version_empty": F.coalesce(F.trim("factor_version") == "", F.lit(True)),
        "horizon_below_one": (F.col("horizon_sessions") < 1, F.col("horizon_sessions")),
        "end_not_after_start": F.col("end_date") <= F.col("as_of_date"),
        "available_without_return": F.col("is_available") & ~is_finite("forward_return"),
        "return_without_availability": (~F.col("is_available") & is_finite("forward_return"), F.col("forward_return")),
    })
    mixed = (
        labels.groupBy("as_of_date")
        .agg(F.count_distinct("end_date", "horizon_sessions").alias("n"))
        .where("n > 1")
    )
    labelled = grid.join(labels.select("as_of_date").distinct(), "as_of_date", "left_semi")
    return union_all(
        rows, columns,
        repeated(labels, "row_repeated", "as_of_date", "symbol", "factor_name"),
        _identities(labels, "factor_name", "factor_version"),
        flagged(mixed, "several_horizons", _key("as_of_date"), F.col("n")),
        flagged(labelled.join(labels, day_symbol, "left_anti"), "symbol_missing", _key(*day_symbol)),
        flagged(labels.join(grid, day_symbol, "left_anti"), "symbol_outside_universe", _key(*day_symbol)),
    )


def price_window_violations(prices: DataFrame, universe: DataFrame) -> DataFrame:
    """Label prices ``(as_of_date, end_date, symbol, date)`` inside their window, known, unique."""
    key = _key("as_of_date", "symbol", "date")
    return union_all(
        row_rules(prices, key, {
            "outside_window": ~F.col("date").between(F.col("as_of_date"), F.col("end_date")),
        }),
        flagged(prices.join(universe, "symbol", "left_anti"), "symbol_outside_universe", key),
        repeated(prices, "price_repeated", "as_of_date", "symbol", "date"),
    )


def strategy_violations(result: DataFrame, grid: DataFrame) -> DataFrame:
    """A result has the result's columns and none of a later layer, under one strategy a date; ranks are unique positive integers; a selection
    has a finite score and a rank."""
    columns, day_symbol = column_violations(result, RESULT_COLUMNS, FORBIDDEN_RESULT_COLUMNS), ["as_of_date", "symbol"]
    if _lacks(result, [*RESULT_COLUMNS, "ord"]):
        return columns
    scored = is_finite("score")
    rank, selected = F.col("rank"), F.col("is_selected")
    rows = row_rules(result, _key(*day_symbol), {
        "score_not_finite": (F.col("score").isNotNull() & ~scored),
        "rank_below_one": (rank < 1, rank),
        "selection_missing": selected.isNull(),
        "selected_without_score": selected & ~scored,
        "selected_without_rank": selected & rank.isNull(),
        "symbol_empty": F.coalesce(F.trim("symbol") == "", F.lit(True)),
        "name_malformed": ~valid_name("strategy_name", exact=False),
        "version_empty": F.coalesce(F.trim("strategy_version") == "", F.lit(True)),
    })
    wanted = grid.select(*day_symbol, F.col("ord").alias("wanted"))
    disordered = result.join(wanted, day_symbol).where("ord <> wanted")
    return union_all(
        rows, columns, _identities(result, "strategy_name", "strategy_version"),
        repeated(result.where("rank >= 1"), "rank_repeated", "as_of_date", "rank"),
        repeated(result, "symbol_repeated", *day_symbol),
        flagged(grid.join(result, day_symbol, "left_anti"), "symbol_missing", _key(*day_symbol)),
        flagged(result.join(grid, day_symbol, "left_anti"), "symbol_outside_universe", _key(*day_symbol)),
        flagged(disordered, "out_of_universe_order", _key(*day_symbol), F.col("ord")),
    )


def weight_completeness(positions: DataFrame, cash: DataFrame) -> DataFrame:
    """Per date: invested weight and whether it adds up to the whole account with the cash."""
    sums = positions.groupBy("as_of_date").agg(F.sum("weight").alias("invested"))
    return cash.join(sums, "as_of_date", "left").select(
        "as_of_date",
        F.coalesce("invested", F.lit(0.0)).alias("invested_weight"),
        "cash_weight",
    ).withColumn(
        "is_complete",
        F.abs(F.col("invested_weight") + F.col("cash_weight") - 1.0) <= WEIGHT_TOLERANCE,
    )


def portfolio_violations(positions: DataFrame, cash: DataFrame, selected: DataFrame) -> DataFrame:
    """Positive weights, no cash symbol, cash a share, everything adding up, only selected names."""
    key = _key("as_of_date", "symbol")
    rows = row_rules(positions, key, {
        "weight_not_positive": (~is_positive("weight"), F.col("weight")),
        "cash_as_symbol": F.col("symbol") == "CASH",
        "symbol_malformed": ~valid_symbol("symbol"),
    })
    share = row_rules(cash, _key("as_of_date"), {
        "cash_outside_share": (~F.col("cash_weight").between(0.0, 1.0), F.col("cash_weight")),
    })
    incomplete = weight_completeness(positions, cash).where("not is_complete")
    return union_all(
        rows, share,
        repeated(positions, "symbol_repeated", "as_of_date", "symbol"),
        flagged(incomplete, "incomplete", _key("as_of_date")),
        flagged(positions.join(selected, ["as_of_date", "symbol"], "left_anti"), "not_selected", key),
    )


def state_violations(states: DataFrame) -> DataFrame:
    """``(as_of_date, state_date)``: a state known only after the decision is look-ahead."""
    return row_rules(states, _key("as_of_date"), {
        "state_after_decision": F.col("state_date") > F.col("as_of_date"),
    })


def transition_violations(transition: DataFrame, state: DataFrame, target: DataFrame) -> DataFrame:
    """A transition restates both portfolios exactly, covers their union and keeps its order."""
    day_symbol = ["as_of_date", "symbol"]
    key = _key(*day_symbol)
    sides = (
        target.select(*day_symbol, F.col("weight").alias("want"), F.col("ord").alias("t_ord"))
        .join(state.select(*day_symbol, F.col("weight").alias("held"), F.col("ord").alias("s_ord")),
              day_symbol, "full_outer")
        .withColumn("place", F.row_number().over(
            Window.partitionBy("as_of_date").orderBy(
                F.col("t_ord").isNull(), F.coalesce("t_ord", "s_ord"), "symbol")))
    )
    zero = F.lit(0.0)
    both = transition.withColumn("given", F.lit(True)).join(sides.withColumn("expected", F.lit(True)), day_symbol, "full_outer")
    gap_now = F.abs(F.col("current_weight") - F.coalesce("held", zero))
    gap_then = F.abs(F.col("target_weight") - F.coalesce("want", zero))
    gap_move = F.abs(F.col("weight_change") - (F.col("target_weight") - F.col("current_weight")))
    present = F.col("given").isNotNull() & F.col("expected").isNotNull()
    return union_all(
        row_rules(both, key, {
            "row_missing": F.col("given").isNull(),
            "row_unexpected": F.col("expected").isNull(),
            "current_disagrees": present & (gap_now > WEIGHT_TOLERANCE),
            "target_disagrees": present & (gap_then > WEIGHT_TOLERANCE),
            "change_disagrees": present & (gap_move > WEIGHT_TOLERANCE),
            "out_of_order": (present & (F.col("position") != F.col("place")), F.col("position")),
        }),
        repeated(transition, "row_repeated", *day_symbol),
    )


def order_violations(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Ids unique, one order per symbol and event, dates of the event, sides and sizes."""
    key = F.col("order_id")
    rows = row_rules(orders, key, {
        "id_empty": F.coalesce(F.trim("order_id") == "", F.lit(True)),
        "id_padded": F.col("order_id") != F.trim("order_id"),
        "side_unknown": ~F.coalesce(F.col("side").isin(ORDER_SIDES), F.lit(False)),
        "quantity_not_positive": (~is_positive("quantity"), F.col("quantity")),
        "fill_not_after_decision": F.col("scheduled_fill_date") <= F.col("decision_date"),
        "symbol_malformed": ~valid_symbol("symbol"),
    })
    dated = orders.join(events, "decision_date", "left")
    return union_all(
        rows,
        repeated(orders, "id_repeated", "order_id"),
        repeated(orders, "symbol_ordered_twice", "decision_date", "symbol"),
        row_rules(dated, key, {
            "decision_without_event": F.col("execution_date").isNull(),
            "not_the_event_session": F.col("execution_date") != F.col("scheduled_fill_date"),
        }),
    )


def fill_violations(fills: DataFrame, orders: DataFrame, start: date, end: date) -> DataFrame:
    """Fills execute their own order completely, on its session, inside the window, in order."""
    key = F.col("order_id")
    asked = orders.select(
        "order_id", F.col("scheduled_fill_date").alias("due"), F.col("quantity").alias("ordered")
    )
    rows = row_rules(fills.join(asked, "order_id", "left"), key, {
        "order_unknown": F.col("ordered").isNull(),
        "wrong_session": F.col("fill_date") != F.col("due"),
        "partial_fill": (F.col("quantity") != F.col("ordered"), F.col("quantity")),
        "price_not_positive": (~is_positive("fill_price"), F.col("fill_price")),
        "cost_negative": (~is_non_negative("transaction_cost"), F.col("transaction_cost")),
        "notional_not_finite": ~is_finite(F.col("fill_price") * F.col("quantity")),
        "cash_not_finite": ~is_finite(F.col("fill_price") * F.col("quantity") + F.col("transaction_cost")),
        "outside_window": ~F.col("fill_date").between(F.lit(start), F.lit(end)),
    })
    return union_all(rows, repeated(fills, "order_filled_twice", "order_id"))


def history_order_violations(history: DataFrame, key: str, partition: str, *order: str) -> DataFrame:
    """Recorded positions that disagree with the order the record promises.

    Compared inside ``partition``, so the check never sorts the whole history in one task.
    """
    place = F.row_number().over(Window.partitionBy(partition).orderBy(*order))
    stated = F.row_number().over(Window.partitionBy(partition).orderBy("position"))
    ranked = history.withColumn("place", place).withColumn("stated", stated)
    return row_rules(ranked, F.col(key).cast("string"), {
        "out_of_order": (F.col("place") != F.col("stated"), F.col("position")),
    })


def valuation_violations(values: DataFrame, start: date, end: date) -> DataFrame:
    """Daily values add up, are never negative, unique and inside the window."""
    total = F.col("cash") + F.col("market_value")
    return union_all(
        row_rules(values, _key("as_of_date"), {
            "nav_disagrees": F.abs(F.col("nav") - total) > NAV_TOLERANCE,
            "cash_negative": (~is_non_negative("cash"), F.col("cash")),
            "market_value_negative": (~is_non_negative("market_value"), F.col("market_value")),
            "nav_negative": (~is_non_negative("nav"), F.col("nav")),
            "outside_window": ~F.col("as_of_date").between(F.lit(start), F.lit(end)),
        }),
        repeated(values, "date_repeated", "as_of_date"),
    )


def closing_violations(values: DataFrame, final_state: DataFrame) -> DataFrame:
    """The closing state ``(as_of_date, cash)`` is the state of the last valuation."""
    last = values.agg(F.max_by("cash", "as_of_date").alias("last_cash"), F.max("as_of_date").alias("last_date"))
    both = final_state.select(
        "as_of_date", "cash",
        last.select("last_date").scalar().alias("last_date"),
        last.select("last_cash").scalar().alias("last_cash"),
    )
    same_day = F.col("as_of_date") == F.col("last_date")
    return row_rules(both, _key("as_of_date"), {
        "not_the_last_session": ~same_day,
        "cash_disagrees": same_day & (F.abs(F.col("cash") - F.col("last_cash")) > NAV_TOLERANCE),
    })


def publish_violations(staged: DataFrame, live: DataFrame) -> DataFrame:
    """After a publish, per symbol: same row count as staged, no copies, nothing else."""
    want = staged.groupBy("symbol").agg(F.count("*").alias("staged_rows"))
    have = live.groupBy("symbol").agg(F.count("*").alias("live_rows"))
    both = want.join(have, "symbol", "full_outer")
    return union_all(
        row_rules(both, F.col("symbol"), {
            "row_count_differs": (
                F.coalesce("staged_rows", F.lit(0)) != F.coalesce("live_rows", F.lit(0)),
                F.coalesce("live_rows", F.lit(0)),
            ),
            "symbol_unexpected": F.col("staged_rows").isNull(),
        }),
        repeated(live, "row_repeated", "symbol", "date"),
    )


def ic_report_consistency(ics: DataFrame, reported: DataFrame) -> DataFrame:
    """A reported summary equals the one recomputed from its own observations."""
    key = ["factor_name", "factor_version", "horizon_sessions"]
    fields = ["mean_ic", "ic_std", "icir"]
    fresh = ic_summary(ics).select(
        *key, F.col("valid_ic_count").alias("n_"), *[F.col(f).alias(f"{f}_") for f in fields]
    )
    both = reported.join(fresh, key, "full_outer")
    return union_all(
        row_rules(both, _key(*key), {
            "count_disagrees": (~F.col("valid_ic_count").eqNullSafe(F.col("n_")), F.col("valid_ic_count")),
            **{f"{f}_disagrees": ~agrees(f, f"{f}_", SUMMARY_TOLERANCE) for f in fields},
        }),
        repeated(ics, "date_repeated", *key, "as_of_date"),
        row_rules(ics, _key("as_of_date"), {"ic_outside_range": (F.abs("ic") > 1.0, F.col("ic"))}),
    )


def quantile_block_consistency(observations: DataFrame, spreads: DataFrame) -> DataFrame:
    """Each date has every group once, members add up, and the spread follows from the groups."""
    def differs(name):
        return ~F.min(name).eqNullSafe(F.max(name))

    blocks = observations.groupBy("as_of_date").agg(
        F.count("*").alias("groups"), F.count_distinct("quantile").alias("distinct_groups"),
        F.min("quantile").alias("lo"), F.max("quantile").alias("hi"), F.max("quantiles").alias("q"),
        F.sum("member_count").alias("members"), F.max("paired_count").alias("paired"),
        F.sum("member_coverage").alias("coverage"), F.max("paired_coverage").alias("paired_coverage"),
        differs("end_date").alias("ends_differ"), differs("universe_size").alias("sizes_differ"),
        differs("paired_count").alias("pairs_differ"),
    )
    key = _key("as_of_date")
    incomplete = (
        (F.col("groups") != F.col("q")) | (F.col("distinct_groups") != F.col("q"))
        | (F.col("lo") != 1) | (F.col("hi") != F.col("q"))
    )
    rows = row_rules(blocks, key, {
        "groups_incomplete": (incomplete, F.col("groups")),
        "members_disagree": (F.col("members") != F.col("paired"), F.col("members")),
        "coverage_disagrees": ~agrees("coverage", "paired_coverage", SUMMARY_TOLERANCE),
        "end_dates_differ": F.col("ends_differ"),
        "universe_sizes_differ": F.col("sizes_differ"),
        "paired_counts_differ": F.col("pairs_differ"),
    })
    fields = ["bottom_mean_forward_return", "top_mean_forward_return", "top_minus_bottom"]
    fresh = quantile_spread(observations).select("as_of_date", *[F.col(f).alias(f"{f}_") for f in fields])
    both = spreads.select("as_of_date", *fields).join(fresh, "as_of_date", "full_outer")
    return rows.unionByName(
        row_rules(both, key, {f"{f}_disagrees": ~agrees(f, f"{f}_", SUMMARY_TOLERANCE) for f in fields})
    )


def schedule_violations(
    decisions: DataFrame, rule_dates: DataFrame, events: DataFrame, rule_events: DataFrame,
    calendar: DataFrame, start: date, end: date,
) -> DataFrame:
    """A recorded schedule against what its rule selects and when its delay executes."""
    day = "decision_date"
    sessions = calendar.select(F.col("session").alias(day))
    both = events.select(day, F.col("execution_date").alias("recorded")).join(
        rule_events.select(day, F.col("execution_date").alias("due")), day, "full_outer"
    )
    return union_all(
        flagged(decisions.join(sessions, day, "left_anti"), "not_a_session", _key(day)),
        flagged(decisions.where(~F.col(day).between(F.lit(start), F.lit(end))), "outside_window", _key(day)),
        repeated(decisions, "decision_repeated", day),
        flagged(rule_dates.join(decisions, day, "left_anti"), "decision_missing", _key(day)),
        flagged(decisions.join(rule_dates, day, "left_anti"), "decision_unexpected", _key(day)),
        flagged(events.join(decisions, day, "left_anti"), "event_without_decision", _key(day)),
        repeated(events, "event_repeated", day),
        row_rules(both, _key(day), {
            "event_missing": F.col("recorded").isNull(),
            "event_unexpected": F.col("due").isNull(),
            "execution_disagrees": F.col("recorded") != F.col("due"),
        }),
    )
