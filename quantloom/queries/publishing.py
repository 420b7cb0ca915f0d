"""Versioned publishing, the stream's quarantine and the ledger of deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import bars as bar_io
from ..sources import versions
from ..streaming.incremental import fold_batch, incremental_bars, incremental_rejects
from .inputs import Market
from .registry import query

REVISED = "SELECT * REPLACE (volume + 1 AS volume) FROM o_std WHERE symbol = 'BRAND.3'"


def _totals(rows, stage: str):
    return rows.groupBy("symbol").agg(F.count("*").alias("bars"), F.sum("volume").alias("volume")).select(F.lit(stage).alias("stage"), "*")


@query("publish_versions", f"""
SELECT stage, symbol, count(*) AS bars, sum(volume) AS volume FROM (
  SELECT 'begun' AS stage, * FROM o_std UNION ALL SELECT 'refused', * FROM o_std UNION ALL SELECT 'first', * FROM o_std
  UNION ALL SELECT 'live', * FROM o_std WHERE symbol <> 'BRAND.3' UNION ALL SELECT 'live', * FROM ({REVISED}))
GROUP BY stage, symbol""", ints=["volume"])
def publish_versions(m: Market):
    """Readers around a publish that is refused at its confirmation and one that succeeds: begun before both, after the refusal, of the first
    snapshot, and of the one in force."""
    root = scratch_path(m.spark, "live")
    bar_io.publish_bars(m.standard, root)
    begun = bar_io.read_bars(m.spark, root)
    revised = m.standard.where("symbol = 'BRAND.3'").withColumn("volume", F.col("volume") + 1)
    revised = revised.withColumn("dollar_volume", F.col("close") * F.col("volume"))

    def refuse(staged, live):
        raise ValueError("not confirmed")

    try:
        versions.commit(m.spark, root, revised, bar_io.write_bars, confirm=refuse)
    except ValueError:
        refused = bar_io.read_bars(m.spark, root)
    bar_io.publish_bars(revised, root)
    stages = {"begun": begun, "refused": refused, "first": bar_io.read_bars(m.spark, root, snapshot=1), "live": bar_io.read_bars(m.spark, root)}
    out = None
    for stage, rows in stages.items():
        out = _totals(rows, stage) if out is None else out.unionByName(_totals(rows, stage))
    return out


@query("damaged_versions", """
SELECT symbol, CAST(year(date) AS INT) AS year, CASE WHEN symbol = 'BRAND.21' THEN 'missing' ELSE 'truncated' END AS problem FROM o_std
WHERE (symbol = 'BRAND.21' AND year(date) = 1996) OR (symbol = 'BRAND.2' AND year(date) = 1997) GROUP BY symbol, year(date)""")
def damaged_versions(m: Market):
    """A published table of which one folder is lost and another one cut short."""
    root = scratch_path(m.spark, "live")
    bar_io.publish_bars(m.standard, root)
    data = f"{root}/data/version={versions.Snapshot.at(m.spark, root, 1).live[0]}"
    versions.remove(m.spark, f"{data}/symbol=BRAND.21/year=1996")
    year = bar_io.read_bars(m.spark, root).where("symbol = 'BRAND.2' and year(date) = 1997")
    short = scratch_path(m.spark, "short")
    year.where(F.col("date") > year.agg(F.min("date")).scalar()).drop("symbol").write.parquet(short)
    m.spark.read.parquet(short).write.mode("overwrite").parquet(f"{data}/symbol=BRAND.2/year=1997")
    return versions.damaged_keys(m.spark, root).select("symbol", "year", "problem")


def _vendor(m: Market):
    """All bars as vendor rows, with the symbol's number and its first day before and since 1998."""
    firsts = F.col("date") < "1998-01-01"
    rows = m.stored_bars.join(m.pool.select("symbol", "ord"), "symbol").withColumn("early", firsts)
    marks = rows.groupBy("symbol", "early").agg(F.min("date").alias("first"))
    return rows.join(marks, ["symbol", "early"])


def _raw(rows, opens=None, lows=None):
    return rows.select(
        F.col("date").cast("string").alias("Date"), "symbol", (F.col("open") if opens is None else opens).alias("Open"), F.col("high").alias("High"),
        (F.col("low") if lows is None else lows).alias("Low"), F.col("close").alias("Close"), F.col("adjusted_close").alias("Adj Close"),
        F.col("volume").alias("Volume"))


def _deliveries(m: Market) -> str:
    """Two deliveries through the stream, the second again, and one that is older than both.

    The first has bars before 1998; every fourth symbol has a row without a readable day too, and every fourth a first bar of negative price. The second
    has the bars since 1998, without the symbols of 1 modulo 8; it corrects those first bars, and the first new bar of every fourth symbol has a low
    above its high. The old one has other closes for bars of 1996 that have been delivered.
    """
    base = scratch_path(m.spark, "stream")
    vendor = _vendor(m)
    kind, first = F.pmod("ord", F.lit(4)), F.col("date") == F.col("first")
    early, late = vendor.where("early"), vendor.where("not early and ord % 8 <> 1")
    unread = early.where((kind == 1) & first)
    parts = [
        _raw(early, opens=F.when((kind == 2) & first, F.lit(-1.0)).otherwise(F.col("open"))).unionByName(_raw(unread).withColumn("Date", F.lit("soon"))),
        _raw(late, lows=F.when((kind == 3) & first, F.col("high") * 2).otherwise(F.col("low"))).unionByName(_raw(early.where((kind == 2) & first))),
    ]
    for part in parts:
        part.write.mode("append").parquet(f"{base}/raw")
        incremental_bars(m.spark, f"{base}/raw", part.schema, f"{base}/live", f"{base}/checkpoint", name="vendor").awaitTermination()

    def placed(rows, micros):
        return rows.withColumns({"modified_": F.timestamp_micros(F.lit(micros)), "file_": F.lit("old"), "row_": F.monotonically_increasing_id()})

    old = _raw(vendor.where((kind == 0) & (F.year("date") == 1996))).withColumn("Close", F.col("Low")).withColumn("Volume", F.col("Volume") + 5)
    fold_batch(placed(old, 4_102_444_800_000_000), f"{base}/live", "vendor#1")
    fold_batch(placed(old, 1_000_000), f"{base}/live", "vendor#old")
    return f"{base}/live"


TAKEN = """
SELECT b.* EXCLUDE (ord) FROM (SELECT b.*, p.ord FROM o_bars b JOIN o_pool p USING (symbol)) b
WHERE ord % 8 <> 1 AND (ord % 4 <> 3 OR date < DATE '1998-01-01')"""


@query("incremental_quarantine", f"SELECT date, symbol, open, high, low, close, volume FROM ({TAKEN})", dates=["date"])
def incremental_quarantine(m: Market):
    """What is published after deliveries with unreadable days, bad prices, a correction, a replay and one out of order."""
    return bar_io.read_bars(m.spark, _deliveries(m)).select("date", "symbol", "open", "high", "low", "close", "volume")


@query("incremental_rejects", """
WITH b AS (SELECT b.symbol, b.date, p.ord, b.date = min(b.date) OVER (PARTITION BY b.symbol, b.date < DATE '1998-01-01') AS is_first
           FROM o_bars b JOIN o_pool p USING (symbol))
SELECT symbol, date, CASE WHEN ord % 4 = 3 AND is_first THEN 'high_below_range,low_above_range' ELSE '' END AS reasons FROM b
WHERE (ord % 8 = 1 AND date < DATE '1998-01-01') OR (ord % 4 = 3 AND date >= DATE '1998-01-01')
UNION ALL SELECT symbol, NULL, 'unparseable_date' FROM b WHERE ord % 4 = 1 AND is_first AND date < DATE '1998-01-01'""", dates=["date"])
def rejects(m: Market):
    """The rows that wait after those deliveries, each with its reasons."""
    return incremental_rejects(m.spark, _deliveries(m)).select("symbol", "date", F.array_join(F.array_sort("reasons"), ",").alias("reasons"))


@query("delivery_ledger", f"""
SELECT 1 AS number, 'vendor#0' AS token, count(*) AS delivered_rows FROM o_bars JOIN o_pool USING (symbol)
WHERE ord % 4 IN (0, 3) AND date < DATE '1998-01-01'
UNION ALL SELECT 2, 'vendor#1', count(*) FROM ({TAKEN}) JOIN o_pool USING (symbol) WHERE ord % 4 <> 3
UNION ALL SELECT 3, 'vendor#old', 0""")
def delivery_ledger(m: Market):
    """The deliveries that are part of the table: the one that came twice is there once."""
    return versions.ledger(m.spark, _deliveries(m)).select("number", "token", "delivered_rows")
