"""Every operator as a runnable query over the given tables, with SQL that must agree."""

from .registry import ORACLES, QUERIES
from . import (  # noqa: F401  (importing registers the queries)
    aggregates, calendars, checks, functions, jobs, joins, projections, publishing, sets, sources, windows,
)

__all__ = ["ORACLES", "QUERIES"]
