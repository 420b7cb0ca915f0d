"""Symbol, name and label text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FALSE_WORDS, MAX_SYMBOL_LENGTH, NAME_PATTERN, SYMBOL_PATTERN, TRUE_WORDS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x) -> Column:
    """Trimmed text; NULL becomes the empty string."""
    return F.trim(F.coalesce(_c(x).cast("string"), F.lit("")))


def valid_symbol(x, *, exact: bool = True, max_length: int | None = None) -> Column:
    """Upper-case letters, digits, dot and dash. ``exact=False`` tolerates one
    trailing newline, as a ``$``-anchored search does."""
    tail = r"\z" if exact else r"\n?\z"
    ok = F.coalesce(_c(x).rlike(rf"\A{SYMBOL_PATTERN}{tail}"), F.lit(False))
    if max_length is not None:
        ok = ok & (F.length(_c(x)) <= F.lit(max_length))
    return ok


def valid_name(x, *, exact: bool = True) -> Column:
    tail = r"\z" if exact else r"\n?\z"
    return F.coalesce(_c(x).rlike(rf"\A{NAME_PATTERN}{tail}"), F.lit(False))


def bool_word(x) -> Column:
    """TRUE / FALSE for the accepted words, NULL for anything else."""
    word = F.lower(F.trim(_c(x).cast("string")))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def vendor_ticker(x) -> Column:
    """Share-class spelling used by vendors: ``BRK.B`` is listed as ``BRK-B``."""
    return F.translate(_c(x), ".", "-")


def reason_label(reasons) -> Column:
    """Distinct reasons in first-seen order, joined by ``+``."""
    return F.array_join(F.array_distinct(_c(reasons)), "+")
