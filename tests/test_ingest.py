"""Deliveries that are late, repeated, unreadable or not asked for, and publishes that fail."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quantloom.operators import execution, quality
from quantloom.plans.portfolio import strategy_run
from quantloom.plans.update import update_bars
from quantloom.session import scratch_path
from quantloom.sources import bars as bar_io
from quantloom.streaming.incremental import incremental_bars, incremental_rejects

from .conftest import days, rows
from .test_bars import JAN, raw, standard


def deliver(spark, vendor, root, names, run="r"):
    base = scratch_path(spark, "update")
    symbols = spark.createDataFrame([(n,) for n in names], "symbol string")
    got = update_bars(
        symbols, root, lambda windows: vendor, days(spark, [d.isoformat() for d in JAN]), JAN[0], JAN[3],
        run_id=run, raw_root=f"{base}/raw", log_root=f"{base}/log", overlap=1,
    )
    return got, base


def test_unreadable_day_fails_its_symbol_and_keeps_what_is_published(spark):
    root = scratch_path(spark, "live")
    bar_io.write_bars(standard(spark, ("A", JAN[0], 1, 1), ("B", JAN[0], 1, 1)), root)
    vendor = raw(spark, ("A", "2024-01-03", 5, 1), ("A", "soon", 5, 1), ("B", "2024-01-03", 6, 1), ("ZZZ", "2024-01-03", 7, 1), ("??", "x", 1, 1))
    got, _ = deliver(spark, vendor, root, ["A", "B"])
    assert rows(got, "symbol", "status", "problems") == [("??", "refused", 1), ("A", "failed", 1), ("B", "success", 0), ("ZZZ", "refused", 1)]
    assert rows(bar_io.read_bars(spark, root), "symbol", "date") == [("A", JAN[0]), ("B", JAN[0]), ("B", JAN[1])]


def test_last_delivered_row_wins(spark):
    for closes in ([5, 6, 7], [7, 6, 5]):
        root = scratch_path(spark, "live")
        vendor = raw(spark, *[("A", "2024-01-03", c, 1) for c in closes]).coalesce(1)
        deliver(spark, vendor, root, ["A"])
        assert rows(bar_io.read_bars(spark, root), "close") == [(float(closes[-1]),)]


def test_a_run_lands_once(spark):
    root = scratch_path(spark, "raw")
    bar_io.land_raw(raw(spark, ("A", "2024-01-03", 5, 1)), root, "r")
    with pytest.raises(ValueError):
        bar_io.land_raw(raw(spark, ("A", "2024-01-03", 5, 1)), root, "r")


def test_stream_takes_redeliveries_in_order_and_records_refusals(spark):
    base = scratch_path(spark, "stream")
    first = raw(spark, ("A", "2024-01-02", 1, 1), ("A", "2024-01-02", 2, 1), ("B", "2024-01-02", 1, 1), ("C", "soon", 1, 1), ("C", "2024-01-02", 1, 1))
    second = raw(spark, ("A", "2024-01-02", 3, 1), ("A", "2024-01-03", 9, 1), ("A", "2024-01-03", 4, 1))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(f"{base}/raw")
        incremental_bars(spark, f"{base}/raw", first.schema, f"{base}/live", f"{base}/checkpoint").awaitTermination()
    assert rows(bar_io.read_bars(spark, f"{base}/live"), "symbol", "date", "close") == [("A", JAN[0], 3.0), ("A", JAN[1], 4.0), ("B", JAN[0], 1.0)]
    held = incremental_rejects(spark, f"{base}/live").select("symbol", F.array_join("reasons", ",").alias("why"))
    assert rows(held) == [("C", ""), ("C", "unparseable_date")]


def test_failed_publish_leaves_no_new_partition(spark, monkeypatch):
    root = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 1, 1)), root)

    def broken(staged, live):
        raise RuntimeError("a lost job")

    monkeypatch.setattr(bar_io, "publish_violations", broken)
    with pytest.raises(RuntimeError):
        bar_io.publish_bars(standard(spark, ("A", JAN[0], 9, 1), ("NEW", JAN[0], 9, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "symbol", "close") == [("A", 1.0)]


def test_publish_may_lose_a_year(spark):
    root = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, ("A", date(2023, 1, 3), 1, 1), ("A", JAN[0], 1, 1)), root)
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 2, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "date", "close") == [(JAN[0], 2.0)]


def test_verify_follows_the_columns_there_are(spark):
    good = standard(spark, ("A", JAN[0], 1, 1), ("B", JAN[0], 1, 1))
    assert quality.verify_dataset(good.drop("symbol")).head()["ok"]
    assert quality.verify_dataset(good.drop("date")).head()["issues"] == ["missing column date"]
    holes = good.withColumn("adjusted_close", F.lit(None).cast("double"))
    assert quality.verify_dataset(holes).head()["issues"] == ["null values in adjusted_close"]


def test_repeated_bars_are_refused_in_windows(spark):
    twice = standard(spark, ("A", JAN[0], 1, 1)).unionByName(standard(spark, ("A", JAN[0], 1, 1)))
    with pytest.raises(ValueError):
        bar_io.read_bars_window(twice, ["A"], JAN[1], JAN[2], ["open"])


def test_unpriced_orders_stop_the_run(spark):
    orders = spark.createDataFrame(
        [("o1", JAN[0], JAN[1], "A", "BUY", 1.0), ("o2", JAN[0], JAN[1], "B", "BUY", 1.0)],
        "order_id string, decision_date date, scheduled_fill_date date, symbol string, side string, quantity double")
    opens = spark.createDataFrame([(JAN[1], "A", 10.0)], "date date, symbol string, open double")
    with pytest.raises(ValueError, match="o2"):
        execution.execute_orders(orders, opens)
    assert execution.execute_orders(orders.where("symbol = 'A'"), opens).count() == 1


def test_panel_rows_outside_the_universe_stop_the_strategy(spark):
    panel = spark.createDataFrame(
        [(JAN[0], s, "f", "1", 1.0, True) for s in ("A", "X")],
        "as_of_date date, symbol string, factor_name string, factor_version string, raw_value double, is_eligible boolean")
    grid = spark.createDataFrame([(JAN[0], "A", 1)], "as_of_date date, symbol string, ord int")
    wanted = spark.createDataFrame([("f", "1")], "factor_name string, factor_version string")
    with pytest.raises(ValueError, match="outside the universe"):
        strategy_run(panel, wanted, spark.createDataFrame([(JAN[0],)], "as_of_date date"), grid, lambda p: p)
