"""Incremental update of a published bar table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bars import parse_raw
from ..operators.contracts import bar_violations
from ..operators.merge import merge_bars, merge_report, union_windows
from ..operators.planning import plan_download, short_deliveries
from ..schemas import OVERLAP_SESSIONS
from ..session import durable
from ..sources import versions
from ..sources.bars import has_landed, land_raw, landed, publish_bars, rows_of_symbols
from ..sources.reports import append_run_log

#: A run's record of one symbol, stored with the publish.
RECORD = (
    "run_id string, symbol string, status string, plan_status string, downloaded_rows long, new_dates long, replaced_dates long, problems long, "
    "min_date date, max_date date, windows array<struct<start:date,end:date,reason:string,expected:long,delivered:long>>, short_windows long")
# windows -> vendor rows of those windows, each tagged with its window
Fetch = Callable[[DataFrame], DataFrame]


def rows_in_windows(rows: DataFrame, windows: DataFrame, day: str = "date") -> DataFrame:
    """Rows inside one of their symbol's windows, tagged with it.

    A range join as an equi-join: windows are spread over the months they touch, so a row meets
    the few windows of its own month, and a hot symbol is split by month and by adaptive
    execution. Windows of a symbol never overlap, hence no row is tagged twice.
    """
    spread = windows.where("window_start is not null").select(
        "symbol", "window_start", "window_end", F.col("reason").alias("plan_reason"),
        F.explode(
            F.sequence(F.trunc("window_start", "month"), F.trunc("window_end", "month"), F.expr("interval 1 month"))
        ).alias("month_"),
    )
    return (
        rows.withColumn("month_", F.trunc(day, "month"))
        .join(spread, ["symbol", "month_"])
        .where(F.col(day).between(F.col("window_start"), F.col("window_end")))
        .select(*rows.columns, "window_start", "window_end", "plan_reason")
    )


def update_bars(
    symbols: DataFrame, root: str, fetch: Fetch, calendar: DataFrame, start: date, end: date,
    *, run_id: str, raw_root: str, log_root: str, overlap: int = OVERLAP_SESSIONS,
) -> DataFrame:
    """Plan, fetch, land, merge, check and publish; returns one record per symbol.

    A symbol with an unreadable day among its rows, or whose merged history breaks the contract, keeps its published
    rows and is recorded as failed with the number of problems; the others go on. Rows of symbols that nobody asked
    for, malformed ones among them, are published nowhere and recorded as refused. Of several rows for one day the last
    delivered stays. A window that returned fewer rows than the calendar has sessions is noted in the record; nothing is invented for the rest.

    The run's id is its token in the table's ledger, and its records come into force with its rows. A run that is asked for again after it was
    published changes nothing and gives the records of then; one that landed and failed goes on from the landed rows.
    """
    spark = symbols.sparkSession
    if versions.applied(spark, root, run_id):
        return versions.side_table(spark, root, "runs", RECORD).where(F.col("run_id") == run_id).drop("version")
    published = rows_of_symbols(spark, root, symbols)
    plan = durable(plan_download(symbols, published.select("symbol", "date"), calendar, start, end, overlap), "plan")
    windows = plan.where("status = 'planned'")
    if not has_landed(spark, raw_root, run_id):
        land_raw(fetch(windows), raw_root, run_id)

    asked = windows.select("symbol").distinct()
    parsed = parse_raw(landed(spark, raw_root, run_id))
    strays = durable(
        parsed.join(asked, "symbol", "left_anti").groupBy("symbol").agg(F.count("*").alias("stray_rows")), "strays")
    wanted = parsed.join(asked, "symbol", "left_semi")
    unread = durable(
        wanted.where("date is null").groupBy("symbol").agg(F.count("*").alias("unread_rows")), "unread")
    fresh = durable(
        union_windows(wanted.join(unread, "symbol", "left_anti"), "delivery").withColumn("arrival", F.lit(0).cast("bigint")),
        "fresh")
    touched = published.join(asked, "symbol", "left_semi")
    merged = durable(merge_bars(touched, fresh), "merged")
    broken = durable(
        bar_violations(merged).where(F.col("key").contains("|")).select(F.substring_index("key", "|", 1).alias("symbol"))
        .groupBy("symbol").agg(F.count("*").alias("problems")),
        "broken",
    )
    counts = durable(merge_report(touched, fresh), "counts")
    good = merged.join(broken, "symbol", "left_anti").join(fresh.select("symbol").distinct(), "symbol", "left_semi")

    short = short_deliveries(windows, rows_in_windows(fresh, windows), calendar)
    spans = windows.join(short.select("symbol", "window_start", "expected", "delivered"), ["symbol", "window_start"], "left").groupBy("symbol").agg(
        # a symbol has a handful of windows, at most one per gap
        F.array_sort(F.collect_list(F.struct(
            F.col("window_start").alias("start"), F.col("window_end").alias("end"), "reason", "expected", "delivered"
        ))).alias("windows"),
        F.count("expected").alias("short_windows"),
    )
    status = (
        F.when(F.col("plan_status") != "planned", F.lit("skipped"))
        .when((F.col("problems") > 0) | (F.col("unread_rows") > 0), "failed")
        .when(F.coalesce("downloaded_rows", F.lit(0)) == 0, "failed")
        .otherwise("success")
    )
    records = (
        plan.select("symbol", F.col("status").alias("plan_status")).distinct()
        .join(counts, "symbol", "left").join(broken, "symbol", "left").join(unread, "symbol", "left").join(spans, "symbol", "left")
        .select(
            F.lit(run_id).alias("run_id"), "symbol", status.alias("status"), "plan_status",
            F.coalesce("downloaded_rows", F.lit(0)).alias("downloaded_rows"),
            F.coalesce("new_dates", F.lit(0)).alias("new_dates"),
            F.coalesce("replaced_dates", F.lit(0)).alias("replaced_dates"),
            (F.coalesce("problems", F.lit(0)) + F.coalesce("unread_rows", F.lit(0))).alias("problems"),
            "min_date", "max_date", "windows", F.coalesce("short_windows", F.lit(0)).alias("short_windows"),
        )
    )
    refused = strays.select(
        F.lit(run_id).alias("run_id"), "symbol", F.lit("refused").alias("status"), F.lit("unrequested").alias("plan_status"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("downloaded_rows", "new_dates", "replaced_dates")],
        F.col("stray_rows").alias("problems"),
        *[F.lit(None).cast(records.schema[c].dataType).alias(c) for c in ("min_date", "max_date", "windows")],
        F.lit(0).cast("bigint").alias("short_windows"),
    )
    records = durable(records.unionByName(refused), "records")
    publish_bars(None if good.isEmpty() else good, root, token=run_id, side={"runs": records})
    append_run_log(records, log_root)
    return records
