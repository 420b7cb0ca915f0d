"""Registration of queries and of the SQL they must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .inputs import Market
from .oracle import CTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Engine-neutral output: days as ISO text; order-dependent sums to a fixed number of digits."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "date":
            column = column.cast("string")
        elif name in digits:
            column = F.round(column, digits[name])
        columns.append(column.alias(name))
    return df.select(*columns)


def with_ctes(sql: str) -> str:
    """Prefixes the named building blocks the statement uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in needed)
    return f"WITH {parts}\n{sql}"


def query(
    name: str, sql: str | None = None, *,
    dates: list[str] | None = None, rounded: list[str] | None = None, ints: list[str] | None = None,
    money: list[str] | None = None,
):
    """Registers a function of a :class:`Market`; ``dates``/``ints`` fix the SQL's output types.

    ``rounded`` columns are compared to nine decimals, ``money`` amounts to three.
    """
    digits = {**{c: 9 for c in rounded or []}, **{c: 3 for c in money or []}}
    fixes = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates or []]
    fixes += [f"CAST({c} AS BIGINT) AS {c}" for c in ints or []]
    fixes += [f"round({c}, {n}) AS {c}" for c, n in digits.items()]

    def register(function: Callable[[Market], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(function(Market(spark, sf_dir)), digits)

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            body = f"SELECT * REPLACE ({', '.join(fixes)}) FROM ({sql})" if fixes else sql
            ORACLES[name] = with_ctes(body)
        return function

    return register
