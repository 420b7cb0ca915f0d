"""Runs a query in Spark and its SQL in DuckDB and compares the sorted rows exactly."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return 0.0 if value == 0 else value
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda r: tuple((c is not None, str(type(c)), c) for c in r))


def compare(frame, con, sql) -> str | None:
    """None when equal, else what differs."""
    names, rows = frame.columns, frame.collect()
    result = con.execute(sql)
    o_names, o_rows = [d[0] for d in result.description], result.fetchall()
    if sorted(names) != sorted(o_names):
        return f"columns {sorted(names)} vs {sorted(o_names)}"
    mine, theirs = _rows(names, rows), _rows(o_names, o_rows)
    if len(mine) != len(theirs):
        extra = [r for r in mine if r not in set(theirs)][:2]
        lost = [r for r in theirs if r not in set(mine)][:2]
        return f"{len(mine)} rows vs {len(theirs)}; only spark {extra}; only sql {lost}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(names)}: {a} vs {b}"
    return None
