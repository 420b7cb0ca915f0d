"""Headline queries, timed warm; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quantloom.queries import ORACLES, QUERIES  # noqa: E402
from quantloom.session import build_session  # noqa: E402

HEADLINE = [
    "derive_features", "merge_bars", "bar_violations", "verify_dataset", "plan_download",
    "momentum_12_1", "forward_returns", "panel_statistics", "daily_ic", "quantile_returns",
    "top_n_by_factor", "capped_score_weights", "portfolio_transition", "fill_orders",
    "weekly_schedule", "prev_session_or_same", "panel_range_scan", "factor_research", "portfolio_run",
]
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def duckdb_seconds(names: list[str], sf_dir: str) -> dict[str, float]:
    """The same queries' SQL in DuckDB, once each, for comparison."""
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    out = {}
    for name in names:
        if name in ORACLES:
            start = time.perf_counter()
            con.execute(ORACLES[name]).fetchall()
            out[name] = round(time.perf_counter() - start, 4)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="spark-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            # the callable may write staging tables, so it is part of the time
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:]), 4)
        print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()
    duck = duckdb_seconds(names, sf_dir)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(timings.values()), 4), "unit": "sec",
        "queries": timings, "duckdb": duck, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
