"""Table schemas and the constants every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Column sets, patterns, allow-lists and tolerances of the data contract.
RAW_COLUMNS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
PRICE_COLUMNS = ["open", "high", "low", "close", "adjusted_close"]
STANDARD_COLUMNS = [
    "date", "symbol", "open", "high", "low", "close",
    "adjusted_close", "volume", "daily_return", "dollar_volume",
]
NON_NULL_COLUMNS = ["open", "high", "low", "close", "adjusted_close", "volume", "dollar_volume"]
REQUESTABLE_FIELDS = ["open", "high", "low", "close", "adjusted_close", "volume"]
SYMBOL_PATTERN = r"[A-Z0-9.\-]+"
NAME_PATTERN = r"[a-z0-9_]+"
MAX_SYMBOL_LENGTH = 10
MIN_UNIVERSE_SIZE = 10
EXCHANGES = ["NASDAQ", "NYSE", "NYSE AMERICAN", "NYSE ARCA", "BATS", "OTC"]
SECURITY_TYPES = ["common_stock"]
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]
WEEKDAYS = {"MON": 0, "TUE": 1, "WED": 2, "THU": 3, "FRI": 4}
WEIGHT_TOLERANCE = 1e-12
NAV_TOLERANCE = 1e-9
SUMMARY_TOLERANCE = 1e-12
OVERLAP_SESSIONS = 5
MIN_PAIRS = 2
QUANTILES = 5
SLIPPAGE_BPS = 5.0
MAX_SLIPPAGE_BPS = 10_000.0
ORDER_SIDES = ["BUY", "SELL"]
# columns of results, and columns that no strategy result may carry
LABEL_COLUMNS = [
    "as_of_date", "end_date", "symbol", "factor_name", "factor_version", "horizon_sessions", "forward_return", "is_available",
]
RESULT_COLUMNS = ["as_of_date", "strategy_name", "strategy_version", "symbol", "score", "rank", "is_selected"]
FORBIDDEN_RESULT_COLUMNS = [
    "weight", "target_weight", "current_weight", "market_value", "cash", "quantity", "shares", "side",
    "order", "order_id", "order_type", "fill_price", "price", "cost", "turnover",
]
MOMENTUM_NAME, MOMENTUM_VERSION = "momentum_12_1", "1.0.0"
MOMENTUM_LOOKBACK, MOMENTUM_SKIP = 252, 21

BAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adjusted_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("daily_return", T.DoubleType()),
    T.StructField("dollar_volume", T.DoubleType()),
    # partition keys: declared, never inferred, so ticker 007 stays text
    T.StructField("symbol", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

UNIVERSE = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("symbol", "name", "exchange", "security_type", "is_active")
])

PANEL = T.StructType([
    T.StructField("as_of_date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("factor_name", T.StringType()),
    T.StructField("factor_version", T.StringType()),
    T.StructField("raw_value", T.DoubleType()),
    T.StructField("is_eligible", T.BooleanType()),
])

# Layout of a stored panel: the key columns live in the path.
STORED_PANEL = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("raw_value", T.DoubleType()),
    T.StructField("is_eligible", T.BooleanType()),
    T.StructField("as_of_date", T.DateType()),
    T.StructField("factor_name", T.StringType()),
    T.StructField("factor_version", T.StringType()),
    T.StructField("year", T.IntegerType()),
])
