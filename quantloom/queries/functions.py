"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.transition import transition_status
from .inputs import Market
from .registry import query


@query("fn_symbol_patterns", """
SELECT symbol, line,
       regexp_full_match(symbol, '[A-Z0-9.\\-]+') AS exact,
       regexp_full_match(symbol || chr(10), '[A-Z0-9.\\-]+\\n?') AS with_newline,
       regexp_full_match(lower(name), '[a-z0-9_]+') AS snake FROM o_norm""")
def fn_symbol_patterns(m: Market):
    return m.normalized.select(
        "symbol", "line", fn.valid_symbol("symbol").alias("exact"),
        fn.valid_symbol(F.concat("symbol", F.lit("\n")), exact=False).alias("with_newline"),
        fn.valid_name(F.lower("name")).alias("snake"),
    )


DAYS = """
(SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '2024-02-3' || event_id % 10
   WHEN event_id % 5 = 1 THEN CAST(ts AS VARCHAR) WHEN event_id % 5 = 2 THEN strftime(ts, '%Y%m%d')
   ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS text FROM events)"""


def _day_texts(m: Market):
    five = F.pmod("event_id", F.lit(5))
    return m.table("events").select(
        "event_id",
        F.when(five == 0, F.concat(F.lit("2024-02-3"), F.pmod("event_id", F.lit(10)).cast("string")))
        .when(five == 1, F.col("ts").cast("string"))
        .when(five == 2, F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd"))
        .otherwise(F.to_date("ts").cast("string")).alias("text"),
    )


@query("fn_strict_dates", f"""
SELECT event_id, CASE WHEN regexp_full_match(text, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(text AS DATE) END AS strict_day,
       CASE WHEN regexp_full_match(text[1:10], '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(text[1:10] AS DATE) END AS lenient_day
FROM {DAYS}""", dates=["strict_day", "lenient_day"])
def fn_strict_dates(m: Market):
    return _day_texts(m).select(
        "event_id", fn.strict_date("text").alias("strict_day"), fn.lenient_date("text").alias("lenient_day")
    )


@query("fn_day_normalize", "SELECT event_id, CAST(ts AS DATE) AS day FROM events", dates=["day"])
def fn_day_normalize(m: Market):
    return m.table("events").select("event_id", fn.session_day("ts").alias("day"))


@query("fn_calendar_parts", """
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, CAST(isodow(o_orderdate) - 1 AS INT) AS weekday,
       last_day(o_orderdate) AS month_end FROM orders""", dates=["week", "month_end"])
def fn_calendar_parts(m: Market):
    return m.table("orders").select(
        "o_orderkey", fn.week_start("o_orderdate").alias("week"),
        fn.weekday_index("o_orderdate").alias("weekday"), fn.month_end("o_orderdate").alias("month_end"),
    )


@query("fn_bool_words", "SELECT line, active FROM o_norm")
def fn_bool_words(m: Market):
    return m.messy_master.select("line", fn.bool_word("is_active").alias("active"))


@query("fn_number_checks", """
SELECT event_id, coalesce(isfinite(x), FALSE) AS is_finite, coalesce(isfinite(x) AND x > 0, FALSE) AS is_positive,
       coalesce(isfinite(x) AND x >= 0, FALSE) AS is_non_negative
FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN CAST('nan' AS DOUBLE)
        WHEN event_id % 7 = 2 THEN CAST('inf' AS DOUBLE) WHEN event_id % 7 = 3 THEN CAST('-inf' AS DOUBLE)
        WHEN event_id % 7 = 4 THEN 0.0 WHEN event_id % 7 = 5 THEN -value ELSE value END AS x FROM events)""")
def fn_number_checks(m: Market):
    seven = F.pmod("event_id", F.lit(7))
    x = (
        F.when(seven == 0, F.lit(None)).when(seven == 1, F.lit(float("nan"))).when(seven == 2, F.lit(float("inf")))
        .when(seven == 3, F.lit(float("-inf"))).when(seven == 4, F.lit(0.0))
        .when(seven == 5, -F.col("value")).otherwise(F.col("value"))
    )
    rows = m.table("events").select("event_id", x.alias("x"))
    return rows.select(
        "event_id", fn.is_finite("x").alias("is_finite"), fn.is_positive("x").alias("is_positive"),
        fn.is_non_negative("x").alias("is_non_negative"),
    )


@query("fn_clamp_tolerance", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, least(0.05, greatest(0.02, l_discount)) AS clamped,
       CAST(ceil(l_quantity / 7) AS BIGINT) AS steps, abs(l_discount - l_tax) <= 0.011 AS agrees FROM lineitem""")
def fn_clamp_tolerance(m: Market):
    return m.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.clamp("l_discount", 0.02, 0.05).alias("clamped"),
        F.ceil(F.col("l_quantity") / 7).alias("steps"),
        fn.agrees("l_discount", "l_tax", 0.011).alias("agrees"),
    )


@query("fn_transition_status", """
SELECT as_of_date, symbol, CASE WHEN current_weight = 0 AND target_weight > 0 THEN 'entry'
  WHEN current_weight > 0 AND target_weight = 0 THEN 'exit' WHEN weight_change > 1e-12 THEN 'increase'
  WHEN weight_change < -1e-12 THEN 'decrease' ELSE 'unchanged' END AS status FROM o_move""", dates=["as_of_date"])
def fn_transition_status(m: Market):
    return m.transition.select("as_of_date", "symbol", transition_status().alias("status"))


@query("fn_json_array", """
SELECT p_partkey, '["' || p_brand || '","' || p_type || '"]' AS encoded,
       p_brand || '|' || p_type AS decoded, CAST(NULL AS VARCHAR) AS repeated FROM part""")
def fn_json_array(m: Market):
    texts = F.array("p_brand", "p_type")
    encoded = fn.encode_texts(texts)
    twice = fn.encode_texts(F.array("p_brand", "p_brand"))
    return m.table("part").select(
        "p_partkey", encoded.alias("encoded"),
        F.array_join(fn.decode_texts(encoded), "|").alias("decoded"),
        F.array_join(fn.decode_texts(twice), "|").alias("repeated"),
    )


@query("fn_vendor_ticker", "SELECT p_partkey, replace(upper(replace(p_brand, '#', '.')), '.', '-') AS ticker FROM part")
def fn_vendor_ticker(m: Market):
    symbol = F.upper(F.replace("p_brand", F.lit("#"), F.lit(".")))
    return m.table("part").select("p_partkey", fn.vendor_ticker(symbol).alias("ticker"))


@query("fn_reason_label", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = l_linestatus THEN l_returnflag ELSE l_returnflag || '+' || l_linestatus END AS label
FROM lineitem""")
def fn_reason_label(m: Market):
    return m.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.reason_label(F.array("l_returnflag", "l_linestatus", "l_returnflag")).alias("label"),
    )


@query("fn_json_safe", """
SELECT c_custkey, '{"key":' || c_custkey || ',"segment":"' || c_mktsegment || '","share":'
  || CASE WHEN c_acctbal < 0 THEN 'null' ELSE '0.5' END || '}' AS record FROM customer""")
def fn_json_safe(m: Market):
    share = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.lit(0.5))
    return m.table("customer").select(
        "c_custkey",
        fn.json_record(
            F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"),
            fn.json_number(share).alias("share"),
        ).alias("record"),
    )
