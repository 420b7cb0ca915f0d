"""Column functions: pure expressions that stay inside code generation."""

from .dates import lenient_date, month_end, session_day, strict_date, week_start, weekday_index
from .numbers import (
    agrees, clamp, finite_or_null, is_finite, is_non_negative, is_positive,
    mean_of, moments_of, usable_price,
)
from .records import decode_texts, encode_texts, json_number, json_record
from .text import bool_word, clean_text, reason_label, valid_name, valid_symbol, vendor_ticker

__all__ = [
    "lenient_date", "month_end", "session_day", "strict_date", "week_start", "weekday_index",
    "agrees", "clamp", "finite_or_null", "is_finite", "is_non_negative", "is_positive",
    "mean_of", "moments_of", "usable_price", "decode_texts", "encode_texts", "json_number",
    "json_record", "bool_word", "clean_text", "reason_label", "valid_name", "valid_symbol",
    "vendor_ticker",
]
