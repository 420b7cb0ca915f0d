"""Scans, sources and sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import json_number, json_record
from ..operators.panel import panel_statistics
from ..session import scratch_path
from ..sources import bars as bar_io
from ..sources import panels as panel_io
from ..sources import reports, universe, versions
from .inputs import Market
from .registry import query

BAR_DATES, DERIVED = ["date"], ["daily_return", "dollar_volume"]


def _published(m: Market) -> str:
    root = scratch_path(m.spark, "bars")
    bar_io.write_bars(m.standard, root)
    return root


@query("scan_bars", "SELECT * FROM o_std", dates=BAR_DATES)
def scan_bars(m: Market):
    return bar_io.read_bars(m.spark, _published(m))


@query("scan_symbol", "SELECT * FROM o_std WHERE symbol = 'BRAND.7'", dates=BAR_DATES)
def scan_symbol(m: Market):
    return bar_io.read_symbol(m.spark, _published(m), " brand.7 ")


@query("read_history", """
SELECT date, symbol, close, volume FROM o_std JOIN o_pool USING (symbol)
WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'""", dates=BAR_DATES)
def read_history(m: Market):
    return bar_io.read_history(m.standard, m.pool, date(1996, 1, 1), date(2000, 6, 30), ["close", "volume"])


@query("read_bars_window", """
SELECT date, symbol, open, adjusted_close FROM o_std
WHERE symbol IN ('BRAND.1', 'BRAND.2', 'BRAND.21', 'ABSENT') AND date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'
""", dates=BAR_DATES)
def read_bars_window(m: Market):
    names = ["BRAND.21", "BRAND.1", "BRAND.2", "ABSENT"]
    return bar_io.read_bars_window(
        m.standard, names, date(1996, 1, 1), date(2000, 6, 30), ["open", "adjusted_close"]
    )


@query("window_duplicates", """
SELECT symbol, date, count(*) AS copies FROM o_damaged WHERE symbol IN ('BRAND.1', 'BRAND.2')
GROUP BY symbol, date HAVING count(*) > 1""", dates=BAR_DATES)
def window_duplicates(m: Market):
    return bar_io.window_duplicates(m.damaged, ["BRAND.1", "BRAND.2"])


@query("read_universe", """
SELECT symbol, coalesce(name, '') AS name, exchange, security_type, is_active FROM o_master""")
def read_universe(m: Market):
    path = scratch_path(m.spark, "universe")
    text = m.messy_master.drop("line").na.fill("")
    # padding is data here: the writer must not trim it, nor the reader
    (
        text.write.option("header", True).option("quoteAll", True).option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return universe.read_universe(m.spark, path)


@query("write_bars", "SELECT * , CAST(year(date) AS INT) AS year FROM o_std", dates=BAR_DATES)
def write_bars(m: Market):
    return bar_io.read_bars(m.spark, _published(m)).withColumn("year", F.year("date"))


@query("publish_bars", """
SELECT * FROM o_std WHERE symbol <> 'BRAND.3'
UNION ALL BY NAME SELECT * REPLACE (volume + 1 AS volume, close * (volume + 1) AS dollar_volume) FROM o_std WHERE symbol = 'BRAND.3'
""", dates=BAR_DATES)
def publish_bars(m: Market):
    """A first version of everything, then a revision of one symbol next to it."""
    root = scratch_path(m.spark, "live")
    bar_io.publish_bars(m.standard, root)
    revised = m.standard.where("symbol = 'BRAND.3'").withColumn("volume", F.col("volume") + 1)
    bar_io.publish_bars(revised.withColumn("dollar_volume", F.col("close") * F.col("volume")), root)
    return bar_io.read_bars(m.spark, root)


def _stored(m: Market) -> str:
    root = scratch_path(m.spark, "panels")
    panel_io.write_panels(m.panel, root)
    return root


PANEL_SQL = "SELECT as_of_date, symbol, factor_name, factor_version, raw_value, is_eligible FROM o_panel"


@query("panel_store_write", PANEL_SQL, dates=["as_of_date"])
def panel_store_write(m: Market):
    """Writing the same keys twice leaves them once."""
    root = _stored(m)
    panel_io.write_panels(m.panel.where("as_of_date >= '2000-01-01'"), root)
    return panel_io.read_panels(m.spark, root, "momentum_12_1", "1.0.0")


@query("panel_store_read", PANEL_SQL + " WHERE as_of_date = DATE '2000-10-02'", dates=["as_of_date"])
def panel_store_read(m: Market):
    day = date(2000, 10, 2)
    return panel_io.read_panels(m.spark, _stored(m), "momentum_12_1", "1.0.0", day, day)


@query("panel_range_scan", PANEL_SQL + " WHERE as_of_date BETWEEN DATE '2000-03-01' AND DATE '2001-02-28'",
       dates=["as_of_date"])
def panel_range_scan(m: Market):
    rows = panel_io.read_panels(
        m.spark, _stored(m), "momentum_12_1", "1.0.0", date(2000, 3, 1), date(2001, 2, 28)
    )
    return rows.orderBy("as_of_date", "symbol")


@query("panel_cache_plan", """
SELECT session AS as_of_date, CASE WHEN session < DATE '2000-01-01' THEN 'hit' ELSE 'miss' END AS outcome FROM o_cal
""", dates=["as_of_date"])
def panel_cache_plan(m: Market):
    root = scratch_path(m.spark, "panels")
    panel_io.write_panels(m.panel.where("as_of_date < '2000-01-01'"), root)
    return panel_io.cache_plan(m.dates, panel_io.stored_keys(m.spark, root))


def _move(m: Market, source: str, target: str) -> None:
    place = m.spark._jvm.org.apache.hadoop.fs.Path
    fs = place(source).getFileSystem(m.spark._jsc.hadoopConfiguration())
    if not fs.rename(place(source), place(target)):
        raise OSError(f"{source} could not be moved")


@query("misfiled_panels", """
SELECT session AS as_of_date, year(session)::INT AS year, CASE year(session) WHEN 1996 THEN 'misfiled' ELSE 'missing' END AS problem
FROM o_cal WHERE year(session) IN (1996, 1999)""", dates=["as_of_date"])
def misfiled_panels(m: Market):
    """A store of which one year's folder was moved to another year and one was lost: told from the records, no panel is read."""
    root = _stored(m)
    folder = f"{root}/factor_name=momentum_12_1/factor_version=1.0.0"
    _move(m, f"{folder}/year=1996", f"{folder}/year=1890")
    versions.remove(m.spark, f"{folder}/year=1999")
    return panel_io.panel_problems(m.spark, root).select("as_of_date", "year", "problem")


@query("missing_panel_keys", """
SELECT 'momentum_12_1' AS factor_name, version AS factor_version, session AS as_of_date
FROM o_cal, (VALUES ('1.0.0'), ('2.0.0')) v(version) WHERE version = '2.0.0' OR year(session) IN (1997, 2000)""", dates=["as_of_date"])
def missing_panel_keys(m: Market):
    """Wanted keys without a record: two years that were never stored, and a version that does not exist."""
    root = scratch_path(m.spark, "panels")
    panel_io.write_panels(m.panel.where("year(as_of_date) not in (1997, 2000)"), root)
    wanted = m.dates.select(
        F.lit("momentum_12_1").alias("factor_name"), F.explode(F.array(F.lit("1.0.0"), F.lit("2.0.0"))).alias("factor_version"), "as_of_date")
    return panel_io.missing_keys(m.spark, root, wanted)


@query("research_report", """
SELECT as_of_date, universe_size, eligible_count, valid_count, missing_count, mean, minimum, maximum FROM o_stats
""", dates=["as_of_date"], rounded=["mean"])
def research_report(m: Market):
    """The statistics table read back from a written report."""
    stats = panel_statistics(m.panel)
    tables = {name: stats for name in reports.REPORT_TABLES}
    meta = stats.agg(F.count("*").alias("panel_count"), json_number(F.max("mean")).alias("largest_mean"))
    path = reports.write_report(scratch_path(m.spark, "reports"), "run-1", tables, meta)
    return reports.read_report_table(m.spark, path, "panel_statistics", stats.schema).select(
        "as_of_date", "universe_size", "eligible_count", "valid_count", "missing_count",
        "mean", "minimum", "maximum",
    )


@query("land_raw", """
SELECT "Date", symbol, "Close", "Volume", 'run-1' AS run_id FROM o_raw
UNION ALL SELECT "Date", symbol, "Close", "Volume", 'run-2' FROM o_raw WHERE "Date" = 'soon'""")
def land_raw(m: Market):
    root = scratch_path(m.spark, "raw")
    bar_io.land_raw(m.raw, root, "run-1")
    bar_io.land_raw(m.raw.where("Date = 'soon'"), root, "run-2")
    return m.spark.read.schema(m.raw.withColumn("run_id", F.lit("")).schema).parquet(root).select(
        "Date", "symbol", "Close", "Volume", "run_id"
    )


@query("run_log", """
SELECT 'run-1' AS run_id, symbol, CASE WHEN count(*) > 300 THEN 'success' ELSE 'failed' END AS status,
       count(*) AS row_count, min(date) AS min_date, max(date) AS max_date FROM o_std GROUP BY symbol
UNION ALL SELECT 'run-2', symbol, 'skipped', 0, NULL, NULL FROM o_pool""", dates=["min_date", "max_date"])
def run_log(m: Market):
    root = scratch_path(m.spark, "log")
    first = m.standard.groupBy("symbol").agg(
        F.count("*").alias("row_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    ).select(
        F.lit("run-1").alias("run_id"), "symbol",
        F.when(F.col("row_count") > 300, "success").otherwise("failed").alias("status"),
        "row_count", "min_date", "max_date",
    )
    second = m.pool.select(
        F.lit("run-2").alias("run_id"), "symbol", F.lit("skipped").alias("status"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"),
    )
    reports.append_run_log(first, root)
    reports.append_run_log(second, root)
    return m.spark.read.schema(first.schema).json(root)


@query("batch_manifest", """
SELECT as_of_date, 'momentum_12_1' AS factor_name, universe_size, eligible_count,
       CASE WHEN eligible_count = 0 THEN 'failed' ELSE 'succeeded' END AS status FROM o_stats""", dates=["as_of_date"])
def batch_manifest(m: Market):
    """Per-date results as nested records, written and read back."""
    root = scratch_path(m.spark, "manifest")
    stats = panel_statistics(m.panel)
    records = stats.select(
        "as_of_date",
        F.struct("factor_name", "universe_size", "eligible_count").alias("result"),
        F.when(F.col("eligible_count") == 0, "failed").otherwise("succeeded").alias("status"),
    )
    reports.append_run_log(records, root)
    back = m.spark.read.schema(records.schema).json(root)
    return back.select("as_of_date", "result.*", "status")


@query("long_to_date", """
SELECT event_id, CAST(ts AS DATE) AS day FROM events""", dates=["day"])
def long_to_date(m: Market):
    return m.table("events").select("event_id", F.to_date("ts").alias("day"))


@query("event_records", """
SELECT event_id, '{"day":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '","kind":"' || event_type || '","ratio":'
       || CASE WHEN value > 50 THEN 'null' ELSE '1.0' END || '}' AS record FROM events""")
def event_records(m: Market):
    """JSON-safe rows: ISO days, and a non-finite number written as null."""
    ratio = F.when(F.col("value") > 50, F.lit(float("inf"))).otherwise(F.lit(1.0))
    return m.table("events").select(
        "event_id",
        json_record(
            F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), json_number(ratio).alias("ratio")
        ).alias("record"),
    )
