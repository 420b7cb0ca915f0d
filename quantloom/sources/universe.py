"""Security master files and the pools drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bool_word, clean_text
from ..operators.panel import dense_grid
from ..operators.ranking import checked_bound, running_total
from ..schemas import UNIVERSE


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """A CSV security master, every cell text: ticker ``NA`` is a ticker, not a missing value.

    The header is read on its own first, since a repeated or padded column name must be seen.
    """
    header = spark.read.text(path).limit(1).head()
    names = [n.strip().strip('"').strip() for n in header[0].split(",")] if header else []
    twice = sorted({n for n in names if names.count(n) > 1})
    lacking = [n for n in UNIVERSE.fieldNames() if n not in names]
    if twice or lacking:
        raise ValueError(f"universe header: repeated {twice}, missing {lacking}")
    schema = ", ".join(f"`{n}` string" for n in names)
    # an empty cell stays "" and no text is read as NULL
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        .option("nullValue", "\u0000").option("emptyValue", "").csv(path)
        .select(*UNIVERSE.fieldNames())
    )


def normalize_universe(raw: DataFrame) -> DataFrame:
    """Trimmed text, symbol and exchange upper case, type lower case, words to booleans."""
    return raw.select(
        F.upper(clean_text("symbol")).alias("symbol"),
        clean_text("name").alias("name"),
        F.upper(clean_text("exchange")).alias("exchange"),
        F.lower(clean_text("security_type")).alias("security_type"),
        "is_active",
        bool_word("is_active").alias("active"),
        *[c for c in raw.columns if c not in UNIVERSE.fieldNames()],
    )


def select_entries(
    normalized: DataFrame, requested: DataFrame | None = None, include_inactive: bool = False
) -> DataFrame:
    """Active entries, optionally only the requested symbols; ``ord`` keeps the file order."""
    entries = normalized if include_inactive else normalized.where("active")
    if requested is None:
        return entries
    return entries.join(_wanted(requested), "symbol", "left_semi")


def unknown_symbols(normalized: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested symbols the universe does not have."""
    return _wanted(requested).join(normalized, "symbol", "left_anti")


def _wanted(requested: DataFrame) -> DataFrame:
    return requested.select(F.upper(F.trim("symbol")).alias("symbol")).distinct()


def active_pool(normalized: DataFrame) -> DataFrame:
    """``(symbol, ord)``: active symbols once each, numbered in symbol order."""
    symbols = normalized.where("active").select("symbol").distinct()
    return with_ord(symbols)


def with_ord(symbols: DataFrame) -> DataFrame:
    """Numbers distinct symbols in symbol order: one window when their checked count allows it,
    else prefix counts over range-partitioned slices."""
    ranked = running_total if checked_bound(symbols) is None else _counted
    return ranked(symbols, [], [F.col("symbol")], F.lit(1), "ord").select(
        "symbol", F.col("ord").cast("bigint").alias("ord")
    )


def _counted(df: DataFrame, keys, order, amount, out: str) -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def static_snapshot(normalized: DataFrame, dates: DataFrame, source: str = "static") -> DataFrame:
    """The same pool on every date. Today's members stand in for the past, so results carry
    survivorship bias."""
    return dense_grid(active_pool(normalized), dates).withColumn("source", F.lit(source))


def outside_universe(rows: DataFrame, universe: DataFrame) -> DataFrame:
    return rows.join(universe, "symbol", "left_anti")


def without_rows(universe: DataFrame, rows: DataFrame) -> DataFrame:
    """Universe symbols that have no row at all."""
    return universe.join(rows, "symbol", "left_anti")
