"""End-to-end jobs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from ..operators import schedule, selection
from ..operators.bars import derive_features
from ..operators.panel import momentum
from ..plans import portfolio, research, update
from ..session import durable, scratch_path
from ..sources import bars as bar_io
from ..sources import panels as panel_io
from ..streaming.incremental import incremental_bars as stream_bars
from .inputs import CAP, CASH, PLAN_END, PLAN_START, TOP_N, Market
from .registry import query


def _vendor(m: Market):
    """What a vendor would deliver: one share more than published, two symbols broken."""
    rows = m.stored_bars.join(m.pool, "symbol")
    text = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adjusted_close"}
    broken = F.col("ord").isin(3, 7)
    return rows.select(
        F.col("date").alias("day"), "symbol",
        F.col("date").cast("string").alias("Date"),
        *[
            F.when(broken & F.lit(name == "High"), F.col("low") * 0.5).otherwise(F.col(source)).alias(name)
            for name, source in text.items()
        ],
        (F.col("volume") + 1).alias("Volume"),
    )


def _run_update(m: Market):
    root, run = scratch_path(m.spark, "live"), scratch_path(m.spark, "update")
    held = m.stored_bars.join(m.held_dates, ["symbol", "date"], "left_semi")
    bar_io.write_bars(derive_features(held), root)
    vendor = durable(_vendor(m), "vendor")

    def fetch(windows):
        return update.rows_in_windows(vendor, windows, "day").drop("day")

    records = update.update_bars(
        m.pool.select("symbol"), root, fetch, durable(m.calendar, "calendar"), PLAN_START, PLAN_END,
        run_id="run-1", raw_root=f"{run}/raw", log_root=f"{run}/log",
    )
    return root, records


FRESH = """
(SELECT b.symbol, b.date, b.open, b.high, b.low, b.close, b.adjusted_close, b.volume + 1 AS volume, p.ord
 FROM o_bars b JOIN o_pool p USING (symbol) JOIN o_plan w ON w.symbol = b.symbol AND b.date BETWEEN w.window_start AND w.window_end)"""


@query("update_bars", f"""
SELECT symbol, date, open, high, low, close, adjusted_close, volume,
       adjusted_close / lag(adjusted_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS daily_return,
       close * volume AS dollar_volume
FROM (SELECT f.* EXCLUDE (ord) FROM {FRESH} f WHERE ord NOT IN (3, 7)
      UNION ALL
      SELECT b.symbol, b.date, b.open, b.high, b.low, b.close, b.adjusted_close, b.volume FROM o_bars b JOIN o_held h USING (symbol, date)
      JOIN o_pool p USING (symbol)
      WHERE p.ord IN (3, 7) OR (b.symbol, b.date) NOT IN (SELECT (symbol, date) FROM {FRESH}))""", dates=["date"])
def update_bars(m: Market):
    root, _ = _run_update(m)
    return bar_io.read_bars(m.spark, root)


@query("update_log", f"""
SELECT symbol, CASE WHEN ord IN (3, 7) THEN 'failed' ELSE 'success' END AS status, count(*) AS downloaded_rows,
       count(*) FILTER (h.date IS NULL) AS new_dates, count(*) FILTER (h.date IS NOT NULL) AS replaced_dates
FROM {FRESH} f LEFT JOIN o_held h USING (symbol, date) GROUP BY symbol, ord""")
def update_log(m: Market):
    _, records = _run_update(m)
    return records.select("symbol", "status", "downloaded_rows", "new_dates", "replaced_dates")


def _job(m: Market, store: str | None = None) -> research.FactorJob:
    return research.FactorJob(
        momentum(m.lookback, m.skip), "momentum_12_1", "1.0.0",
        m.stored_bars, m.pool, m.calendar, store or scratch_path(m.spark, "panels"), lookback=m.lookback, log=scratch_path(m.spark, "batches"),
    )


@query("factor_run", "SELECT * FROM o_stats WHERE as_of_date = DATE '2000-10-02'",
       dates=["as_of_date"], rounded=["mean", "std"])
def factor_run(m: Market):
    return research.factor_run(_job(m), date(2000, 10, 2))["statistics"]


MONTHS = """
(SELECT max(session) AS as_of_date FROM o_cal GROUP BY date_trunc('month', session)
 HAVING max(session) BETWEEN DATE '1998-01-01' AND DATE '2001-05-31')"""


def _months(m: Market):
    dates = schedule.monthly_schedule(m.calendar, date(1998, 1, 1), date(2001, 5, 31))
    return dates.withColumnRenamed("decision_date", "as_of_date")


@query("factor_batch", f"""
SELECT as_of_date, CASE WHEN as_of_date < DATE '2000-01-01' THEN 'hit' ELSE 'miss' END AS outcome,
       'succeeded' AS status, CAST(0 AS BIGINT) AS problems FROM {MONTHS}""", dates=["as_of_date"])
def factor_batch(m: Market):
    """Half of the months are stored by a first run, the second computes the rest."""
    job = _job(m)
    panel_io.write_panels(m.panel.where("as_of_date < '2000-01-01'"), job.store)
    return research.factor_batch(job, _months(m))


@query("factor_batch_manifest", f"""
SELECT 'second' AS batch_id, 'momentum_12_1' AS factor_name, as_of_date, CASE WHEN as_of_date < DATE '2000-01-01' THEN 'hit' ELSE 'miss' END AS outcome,
       CASE WHEN year(as_of_date) = 2000 THEN 'failed' ELSE 'succeeded' END AS status,
       CASE WHEN year(as_of_date) = 2000 THEN (SELECT count(*) FROM o_pool) ELSE 0 END AS problems FROM {MONTHS}
UNION ALL SELECT 'first', 'momentum_12_1', as_of_date, 'miss', 'succeeded', 0 FROM {MONTHS} WHERE as_of_date < DATE '2000-01-01'""", dates=["as_of_date"])
def factor_batch_manifest(m: Market):
    """The stored manifests of two batches. The second finds the months before 2000 stored, and its factor leaves eligibility open in 2000."""
    sound = _job(m)

    def broken(bars, dates, universe, calendar):
        eligible = F.when(F.year("as_of_date") != 2000, F.col("is_eligible"))
        return sound.factor(bars, dates, universe, calendar).withColumn("is_eligible", eligible)

    months = durable(_months(m), "months")
    research.factor_batch(sound, months.where("as_of_date < '2000-01-01'"), batch_id="first")
    research.factor_batch(replace(sound, factor=broken), months, batch_id="second")
    schema = "batch_id string, factor_name string, as_of_date date, outcome string, status string, problems long"
    return m.spark.read.schema(schema).json(sound.log)


def _study(m: Market):
    return research.factor_research(_job(m), _months(m), m.horizon, bound=m.bound)


@query("factor_research", f"""
SELECT as_of_date, end_date, universe_size, paired_count, pair_coverage, ic FROM o_ic
WHERE as_of_date IN (SELECT as_of_date FROM {MONTHS})""", dates=["as_of_date", "end_date"])
def factor_research(m: Market):
    """The rank correlations of a study, as its written report holds them."""
    from ..sources.reports import read_report_table

    tables = _study(m)
    path = research.research_report(tables, scratch_path(m.spark, "reports"), "study", horizon=m.horizon)
    schema = tables["ic_observations"].schema
    return read_report_table(m.spark, path, "ic_observations", schema).select(
        "as_of_date", "end_date", "universe_size", "paired_count", "pair_coverage", "ic"
    )


@query("research_metadata", f"""
SELECT 'study' AS research_run_id, count(*) AS panel_count, min(as_of_date) AS first_date, max(as_of_date) AS last_date,
       count(ic) AS valid_ic_count, avg(ic) AS mean_ic, stddev_samp(ic) AS ic_std FROM o_ic
WHERE as_of_date IN (SELECT as_of_date FROM {MONTHS})""",
       dates=["first_date", "last_date"], rounded=["mean_ic", "ic_std"])
def research_metadata(m: Market):
    path = research.research_report(_study(m), scratch_path(m.spark, "reports"), "study", horizon=m.horizon)
    schema = ("research_run_id string, panel_count bigint, first_date date, last_date date, "
              "valid_ic_count bigint, mean_ic double, ic_std double")
    return m.spark.read.schema(schema).json(f"{path}/metadata")


def _strategy(m: Market):
    wanted = m.spark.createDataFrame([("momentum_12_1", "1.0.0")], "factor_name string, factor_version string")
    store = scratch_path(m.spark, "panels")
    panel_io.write_panels(m.panel, store)
    stored = panel_io.read_whole_panels(m.spark, store, "momentum_12_1", "1.0.0", wanted=m.dates)
    return portfolio.strategy_run(
        stored, wanted, m.dates, durable(m.grid, "grid"),
        lambda panel: selection.top_n_by_factor(panel, TOP_N, m.bound),
    )


@query("strategy_run", "SELECT * FROM o_result", dates=["as_of_date"])
def strategy_run(m: Market):
    return _strategy(m)


@query("portfolio_run", """
SELECT *, CASE WHEN current_weight = 0 AND target_weight > 0 THEN 'entry'
  WHEN current_weight > 0 AND target_weight = 0 THEN 'exit' WHEN weight_change > 1e-12 THEN 'increase'
  WHEN weight_change < -1e-12 THEN 'decrease' ELSE 'unchanged' END AS status FROM o_move""",
       dates=["as_of_date"], rounded=["current_weight", "target_weight", "weight_change"])
def portfolio_run(m: Market):
    return portfolio.portfolio_run(_strategy(m), CASH, CAP)["transition"]


@query("portfolio_from_cash", """
SELECT c.as_of_date, coalesce(w, 0) AS buy_weight, CAST(0.0 AS DOUBLE) AS sell_weight, cash_weight - 1.0 AS cash_weight_change,
       0.5 * (coalesce(w, 0) + abs(cash_weight - 1.0)) AS turnover
FROM o_cash c LEFT JOIN (SELECT as_of_date, sum(weight) AS w FROM o_pos GROUP BY as_of_date) USING (as_of_date)
""", dates=["as_of_date"], rounded=["buy_weight", "cash_weight_change", "turnover"])
def portfolio_from_cash(m: Market):
    """Every date started from an empty account."""
    state, cash = portfolio.all_cash(m.dates)
    return portfolio.portfolio_run(m.result, CASH, CAP, state, cash)["totals"]


@query("incremental_bars", "SELECT * FROM o_std", dates=["date"])
def incremental_bars(m: Market):
    """Raw rows replayed as one file per year through a stream."""
    base = scratch_path(m.spark, "stream")
    raw = m.bars.select(
        F.col("date").cast("string").alias("Date"), "symbol", F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
        F.col("adjusted_close").alias("Adj Close"), F.col("volume").alias("Volume"),
    )
    raw.repartition(3, F.year("Date")).write.parquet(f"{base}/raw")
    started = stream_bars(m.spark, f"{base}/raw", raw.schema, f"{base}/live", f"{base}/checkpoint", 1)
    started.awaitTermination()
    return bar_io.read_bars(m.spark, f"{base}/live")
