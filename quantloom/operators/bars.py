"""From raw trades or vendor rows to standard bars."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean_text, usable_price, valid_symbol
from ..schemas import PRICE_COLUMNS, RAW_COLUMNS, STANDARD_COLUMNS

def by_symbol():
    return Window.partitionBy("symbol").orderBy("date")


def pack_order(parts: list[tuple[Column, int]]) -> Column:
    """Non-negative integers packed into one sortable DECIMAL, most significant first.

    ``min_by``/``max_by`` over a struct needs a sort aggregate; a decimal key has a
    fixed-width buffer, so the aggregation hashes and combines on the map side. Digits are
    gathered in long arithmetic, 18 at a time; a value wider than its declared digits raises.
    """
    if sum(digits for _, digits in parts) > 38 or max(digits for _, digits in parts) > 18:
        raise ValueError("the packed key is limited to 38 digits, 18 for each part")
    words: list[tuple[Column, int]] = []
    word, filled = None, 0
    for column, digits in parts:
        rest = F.when(column.between(0, 10**digits - 1), column.cast("bigint")).otherwise(
            F.raise_error(F.lit("a value does not fit the digits of the packed key"))
        )
        while digits:
            take = min(digits, 18 - filled)
            unit = F.lit(10 ** (digits - take))
            piece = F.call_function("div", rest, unit) if digits > take else rest
            rest = F.pmod(rest, unit) if digits > take else rest
            word = piece if word is None else word * F.lit(10**take) + piece
            digits, filled = digits - take, filled + take
            if filled == 18:
                words.append((word, filled))
                word, filled = None, 0
    if filled:
        words.append((word, filled))
    key = None
    for word, width in words:
        piece = word.cast("decimal(18,0)")
        key = piece if key is None else key * F.lit(Decimal(10**width)) + piece
    return key.cast("decimal(38,0)")


def bars_from_trades(trades: DataFrame) -> DataFrame:
    """OHLCV per ``(symbol, date)`` from ``(symbol, date, price, quantity, position)``.

    One hash aggregation; a symbol holding a third of all trades only sends one partial row
    per map task and session.
    """
    return (
        trades.where(usable_price("price").isNotNull())
        .groupBy("symbol", "date")
        .agg(
            F.min_by("price", "position").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "position").alias("close"),
            F.sum("quantity").cast("bigint").alias("volume"),
        )
        .withColumn("adjusted_close", F.col("close") * F.lit(0.97))
        .select("date", "symbol", *PRICE_COLUMNS, "volume")
    )


def derive_features(bars: DataFrame) -> DataFrame:
    """Adds ``daily_return`` (previous row, on the adjusted close) and ``dollar_volume``."""
    previous = F.lag("adjusted_close").over(by_symbol())
    return bars.withColumn(
        "daily_return", F.try_divide(F.col("adjusted_close"), previous) - F.lit(1.0)
    ).withColumn("dollar_volume", F.col("close") * F.col("volume"))


def derive_features_sliced(bars: DataFrame) -> DataFrame:
    """:func:`derive_features` for rows whose copies are not collapsed yet.

    A symbol may then hold any number of rows, so its line is cut by year: the previous row is
    looked up inside the year, and the first one of a year takes the last of the year before.
    """
    sliced = bars.withColumn("year_", F.year("date"))
    inside = Window.partitionBy("symbol", "year_").orderBy("date")
    ends = sliced.groupBy("symbol", "year_").agg(F.max_by("adjusted_close", "date").alias("end_"))
    carried = ends.select(
        "symbol", "year_",
        F.lag("end_").over(Window.partitionBy("symbol").orderBy("year_")).alias("carried_"),
    )
    previous = F.when(F.col("place_") == 1, F.col("carried_")).otherwise(F.col("before_"))
    return (
        sliced.withColumn("before_", F.lag("adjusted_close").over(inside))
        .withColumn("place_", F.row_number().over(inside))
        .join(carried, ["symbol", "year_"], "left")
        .withColumn("daily_return", F.try_divide(F.col("adjusted_close"), previous) - F.lit(1.0))
        .withColumn("dollar_volume", F.col("close") * F.col("volume"))
        .drop("year_", "before_", "place_", "carried_")
    )


def missing_raw_columns(raw: DataFrame) -> list[str]:
    return [name for name in RAW_COLUMNS if name not in raw.columns]


def parse_raw(raw: DataFrame) -> DataFrame:
    """Vendor rows with typed columns; text that is no number or day becomes NULL."""
    missing = missing_raw_columns(raw)
    if missing:
        raise ValueError(f"raw bars lack column(s) {missing}")
    spelled = {
        "open": "Open", "high": "High", "low": "Low", "close": "Close",
        "adjusted_close": "Adj Close",
    }
    extra = [c for c in raw.columns if c not in [*RAW_COLUMNS, "Date", "symbol"]]
    return raw.select(
        F.col("Date").try_cast("timestamp").cast("date").alias("date"),
        F.upper(clean_text("symbol")).alias("symbol"),
        *[F.col(f"`{src}`").try_cast("double").alias(dst) for dst, src in spelled.items()],
        F.col("Volume").try_cast("double").try_cast("bigint").alias("volume"),
        *extra,
    )


def raw_violations(parsed: DataFrame) -> DataFrame:
    """Counts of rows that stop a load: unreadable days and malformed symbols."""
    bad_day = F.col("date").isNull()
    bad_symbol = ~valid_symbol("symbol")
    return (
        parsed.select(
            F.explode(
                F.array_compact(
                    F.array(
                        F.when(bad_day, F.lit("unparseable_date")),
                        F.when(bad_symbol, F.lit("malformed_symbol")),
                    )
                )
            ).alias("rule"),
            "symbol",
        )
        .groupBy("rule", "symbol")
        .agg(F.count("*").alias("row_count"))
    )


def standardize_bars(raw: DataFrame, *, strict: bool = True) -> DataFrame:
    """Vendor rows of many symbols to the standard columns.

    ``strict`` raises on the first unreadable day or malformed symbol; otherwise those rows
    are left out and belong to :func:`raw_violations`.
    """
    parsed = parse_raw(raw)
    if strict:
        parsed = parsed.withColumn(
            "date",
            F.when(F.col("date").isNull(), F.raise_error(F.lit("unparseable date in raw bars")))
            .otherwise(F.col("date")),
        ).withColumn(
            "symbol",
            F.when(valid_symbol("symbol"), F.col("symbol"))
            .otherwise(F.raise_error(F.lit("malformed symbol in raw bars"))),
        )
    else:
        parsed = parsed.where(F.col("date").isNotNull() & valid_symbol("symbol"))
    extra = [c for c in parsed.columns if c not in STANDARD_COLUMNS]
    return derive_features_sliced(parsed).select(*STANDARD_COLUMNS, *extra)


def order_bars(bars: DataFrame) -> DataFrame:
    return bars.orderBy("symbol", "date")
