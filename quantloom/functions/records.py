"""JSON-safe records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import finite_or_null


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_number(x) -> Column:
    """JSON has no NaN or infinity: undefined numbers become null."""
    return finite_or_null(x)


def json_record(*columns) -> Column:
    """One JSON object per row; nulls are kept as explicit nulls, dates as ISO days."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"})


def encode_texts(x) -> Column:
    return F.to_json(_c(x))


def decode_texts(x) -> Column:
    """A JSON array of distinct texts; NULL when malformed or when a text repeats."""
    texts = F.from_json(_c(x), "array<string>")
    return F.when(F.size(F.array_distinct(texts)) == F.size(texts), texts)
