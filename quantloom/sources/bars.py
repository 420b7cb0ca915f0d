"""Reading, writing and publishing partitioned bar tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import versions
from ..operators.bars import bars_from_trades, pack_order
from ..operators.contracts import bar_violations, publish_violations
from ..operators.quality import verify_dataset
from ..schemas import BAR, REQUESTABLE_FIELDS, STANDARD_COLUMNS
from ..session import scratch_path

LAYOUT = ["symbol", "year"]
PRUNE_LIMIT = 1000


def has_files(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def read_bars(
    spark: SparkSession, root: str, start: date | None = None, end: date | None = None, snapshot: int | None = None,
) -> DataFrame:
    """The whole table, or its closed date range; an absent one reads as no rows. A range opens the folders of its years only.

    A published table is read as its snapshot in force says, or as ``snapshot`` does; what is published later does not change rows
    that have been asked for. The schema is given, so ``symbol=007`` stays text and no file is opened to infer types.
    """
    if versions.versioned(spark, root):
        rows = versions.live_rows(spark, root, snapshot)
    elif snapshot is not None:
        raise ValueError(f"{root} has no snapshots")
    elif not has_files(spark, root):
        return spark.createDataFrame([], BAR).select(*STANDARD_COLUMNS)
    else:
        rows = spark.read.schema(BAR).parquet(root)
    if start is not None:
        rows = rows.where((F.col("year") >= start.year) & (F.col("date") >= F.lit(start)))
    if end is not None:
        rows = rows.where((F.col("year") <= end.year) & (F.col("date") <= F.lit(end)))
    return rows.select(*STANDARD_COLUMNS)


def read_symbol(spark: SparkSession, root: str, symbol: str, ordered: bool = True) -> DataFrame:
    """One symbol; the filter is on a partition column, so other folders are not listed."""
    rows = read_bars(spark, root).where(F.col("symbol") == symbol.strip().upper())
    return rows.orderBy("symbol", "date") if ordered else rows


def rows_of_symbols(spark: SparkSession, root: str, symbols: DataFrame) -> DataFrame:
    """Stored rows of the given symbols. Few names become a partition filter, so only their
    folders are read; many stay a semi join."""
    names = [r[0] for r in symbols.select("symbol").distinct().limit(PRUNE_LIMIT + 1).collect()]
    rows = read_bars(spark, root)
    if len(names) <= PRUNE_LIMIT:
        return rows.where(F.col("symbol").isin(names)) if names else rows.where(F.lit(False))
    return rows.join(symbols.select("symbol"), "symbol", "left_semi")


def _checked_fields(fields: list[str]) -> None:
    if not fields or len(set(fields)) != len(fields):
        raise ValueError(f"request each field once and at least one: {fields}")
    barred = [f for f in fields if f not in STANDARD_COLUMNS or f in ("date", "symbol")]
    if barred:
        raise ValueError(f"not requestable: {barred}")


def read_history(
    bars: DataFrame, universe: DataFrame, start: date, as_of: date, fields: list[str]
) -> DataFrame:
    """Universe bars in the closed window, only the requested fields, in their order."""
    _checked_fields(fields)
    return (
        bars.where(F.col("date").between(F.lit(start), F.lit(as_of)))
        .join(universe.select("symbol"), "symbol", "left_semi")
        .select("date", "symbol", *fields)
        .orderBy("symbol", "date")
    )


def _wanted(bars: DataFrame, symbols: list[str]) -> DataFrame:
    return bars.where(F.col("symbol").isin(symbols))


def window_duplicates(bars: DataFrame, symbols: list[str]) -> DataFrame:
    """Copies among the requested symbols anywhere in the table, not only in a window."""
    return (
        _wanted(bars, symbols).groupBy("symbol", "date")
        .agg(F.count("*").alias("copies")).where("copies > 1")
    )


def read_bars_window(
    bars: DataFrame, symbols: list[str], start: date, end: date, fields: list[str]
) -> DataFrame:
    """Bars of the named symbols in the closed window; only stored fields may be asked for.

    Copies of a requested symbol's bar anywhere in the table are refused; no symbols gives the header alone.
    """
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    refused = [f for f in fields if f not in REQUESTABLE_FIELDS]
    if refused or not fields:
        raise ValueError(f"not requestable: {refused or fields}")
    rows = _wanted(bars, symbols) if symbols else bars.where(F.lit(False))
    if symbols:
        _stop_on(window_duplicates(bars, symbols), "repeated bars")
    return (
        rows.where(F.col("date").between(F.lit(start), F.lit(end)))
        .select("date", "symbol", *fields)
        .orderBy("symbol", "date")
    )


def write_bars(bars: DataFrame, root: str, mode: str = "error", layout: list[str] | None = None) -> None:
    """Partitioned Parquet, folders gathered into few files, rows in date order. No rows at all are refused.

    The rebalance hint lets adaptive execution merge small folders into one task and split a
    hot one over several. Pass ``layout=["year"]`` where a folder per symbol would be too many.
    """
    layout = LAYOUT if layout is None else layout
    keys = [F.col(k) for k in ("symbol", "year")]
    seen = Observation()
    before = has_files(bars.sparkSession, root)
    (
        bars.select(*STANDARD_COLUMNS, F.year("date").alias("year"))
        .hint("rebalance", *keys)
        .sortWithinPartitions("symbol", "year", "date")
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(root)
    )
    if not seen.get["rows"]:
        if not before:
            versions.remove(bars.sparkSession, root)
        raise ValueError(f"no bars to write to {root}")


def _stop_on(problems: DataFrame, what: str) -> None:
    sample = problems.limit(5).collect()
    if sample:
        raise ValueError(f"{what}: {[row.asDict() for row in sample]}")


def _sound(staged: DataFrame) -> None:
    verdict = verify_dataset(staged).head()
    if not verdict["ok"]:
        raise ValueError(f"staged bars: {verdict['issues']}")
    _stop_on(bar_violations(staged), "staged bars break the contract")


def _confirmed(staged: DataFrame, live: DataFrame) -> None:
    _stop_on(publish_violations(staged, live), "published bars differ from the staged ones")


def publish_bars(
    bars: DataFrame | None, root: str, *, token: str | None = None, side: dict[str, DataFrame] | None = None, last_order: str | None = None,
) -> DataFrame:
    """Writes the rows as a version, checks it, confirms what readers would see and swaps it in by one rename; returns the rows of
    that version.

    A symbol's whole history is replaced: years that the new version lacks go. Readers see all of it or nothing, and until the swap, or if
    anything fails, exactly what they saw before. A delivery whose ``token`` is in the table's ledger is not published again.
    ``side`` tables are stored with the version and count from the swap on; with them, ``bars`` may be None. Rows that
    were written to ``root`` without versions become its first one.
    """
    spark = (bars if bars is not None else next(iter(side.values()))).sparkSession
    if not versions.versioned(spark, root) and has_files(spark, root) and any(n.startswith("symbol=") for n in versions.names(spark, root)):
        versions.commit(spark, root, read_bars(spark, root), write_bars)
    done = versions.commit(
        spark, root, bars, write_bars, check=_sound, confirm=_confirmed, token=token, side=side, last_order=last_order)
    if done is None:
        return read_bars(spark, root)
    number, version = done
    return versions.live_rows(spark, root, number).where(F.col("version") == version).select(*STANDARD_COLUMNS)


def land_raw(raw: DataFrame, root: str, run_id: str) -> None:
    """Stores vendor rows untouched, next to the window they were fetched for, one folder per run.

    ``delivery`` numbers the rows in the order they were delivered. A run lands once, whole: its id cannot be used again, and a landing that
    was cut off leaves nothing under it.
    """
    spark, folder = raw.sparkSession, f"{root}/run_id={run_id}"
    if has_files(spark, folder):
        raise ValueError(f"run {run_id} has already landed")
    arriving = f"{root}/_arriving/{uuid.uuid4().hex}"
    raw.withColumn("delivery", F.monotonically_increasing_id()).write.parquet(arriving)
    if not versions.take_name(spark, arriving, folder):
        versions.remove(spark, arriving)
        raise ValueError(f"run {run_id} has already landed")


def has_landed(spark: SparkSession, root: str, run_id: str) -> bool:
    return has_files(spark, f"{root}/run_id={run_id}")


def landed(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The vendor rows of one run; other runs' folders are not read."""
    return spark.read.parquet(f"{root}/run_id={run_id}").withColumn("run_id", F.lit(run_id))


def trades_from_lineitem(lineitem: DataFrame, part: DataFrame, grain: str = "week") -> DataFrame:
    """Order lines as trades: the brand is the symbol, price is value per unit.

    The order of trades inside a session is (time, order, line, part).
    """
    # seconds since year 1, so the packed key never meets a negative number
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + 62_135_596_800
    position = pack_order([
        (seconds, 12), (F.col("l_orderkey"), 13), (F.col("l_linenumber"), 2), (F.col("l_partkey"), 11),
    ])
    # the symbol is spelled once per part, not once per trade
    symbols = part.select(
        "p_partkey", F.upper(F.replace("p_brand", F.lit("#"), F.lit("."))).alias("symbol")
    )
    return lineitem.join(symbols, lineitem.l_partkey == symbols.p_partkey).select(
        "symbol",
        F.trunc(F.to_date("l_shipdate"), grain).alias("date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("quantity"),
        position.alias("position"),
    )


__all__ = [
    "bars_from_trades", "has_files", "has_landed", "land_raw", "publish_bars", "read_bars", "read_bars_window",
    "landed", "read_history", "read_symbol", "rows_of_symbols", "trades_from_lineitem", "window_duplicates", "write_bars",
]
