import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quantloom.operators import bars as bar_ops
from quantloom.operators import contracts, merge, quality
from quantloom.plans.update import rows_in_windows, update_bars
from quantloom.session import scratch_path
from quantloom.sources import bars as bar_io
from quantloom.sources import panels as panel_io
from quantloom.sources import reports, universe
from quantloom.streaming.incremental import incremental_bars

from .conftest import days, rows

RAW = "symbol string, Date string, Open string, High string, Low string, Close string, `Adj Close` string, Volume string"
JAN = [date(2024, 1, d) for d in (2, 3, 4, 5)]


def raw(spark, *items):
    return spark.createDataFrame([(s, d, *[str(p)] * 5, str(v)) for s, d, p, v in items], RAW)


def standard(spark, *items):
    frame = spark.createDataFrame([(s, d, *[float(p)] * 5, v) for s, d, p, v in items],
                                  "symbol string, date date, open double, high double, low double, close double, adjusted_close double, volume bigint")
    return bar_ops.derive_features(frame)


def test_standardize_cleans_and_derives(spark):
    got = bar_ops.standardize_bars(raw(spark, (" aapl ", "2024-01-03", 11, 5), ("AAPL", "2024-01-02 09:30:00", 10, "7.0"), ("AAPL", "2024-01-04", "n/a", "x")))
    assert got.columns == ["date", "symbol", "open", "high", "low", "close", "adjusted_close", "volume", "daily_return", "dollar_volume"]
    cells = rows(got, "date", "symbol", "close", "volume", "daily_return")
    assert cells[0] == (JAN[0], "AAPL", 10.0, 7, None)
    assert cells[1][:4] == (JAN[1], "AAPL", 11.0, 5) and cells[1][4] == pytest.approx(.1)
    assert cells[2] == (JAN[2], "AAPL", None, None, None)


def test_unreadable_day_or_symbol_stops_a_strict_load(spark):
    for item in [("A", "soon", 1, 1), ("A B", "2024-01-02", 1, 1)]:
        with pytest.raises(Exception, match="raw bars"):
            bar_ops.standardize_bars(raw(spark, item)).collect()
        assert bar_ops.standardize_bars(raw(spark, item), strict=False).count() == 0
    with pytest.raises(ValueError, match="Volume"):
        bar_ops.standardize_bars(raw(spark).drop("Volume"))


def test_packed_key_orders_and_refuses_wide_values(spark):
    df = spark.createDataFrame([(2, 10**12 + 5, 1), (2, 10**12, 7), (1, 9, 99)], "a bigint, b bigint, c bigint")
    key = bar_ops.pack_order([(F.col("a"), 12), (F.col("b"), 13), (F.col("c"), 2)])
    assert [tuple(r) for r in df.orderBy(key).collect()] == [(1, 9, 99), (2, 10**12, 7), (2, 10**12 + 5, 1)]
    assert [int(r[0]) for r in df.select(key).collect()][2] == 1 * 10**15 + 9 * 100 + 99
    with pytest.raises(Exception, match="digits"):
        df.select(bar_ops.pack_order([(F.col("b"), 3)])).collect()


def test_bars_hash_aggregate_on_the_map_side(spark):
    trades = spark.createDataFrame([("A", JAN[0], 1.0, 2.0, 1)], "symbol string, date date, price double, quantity double, position bigint")
    trades = trades.withColumn("position", bar_ops.pack_order([(F.col("position"), 18)]))
    plan = bar_ops.bars_from_trades(trades)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_downloaded_rows_win_and_the_last_delivery_counts(spark):
    old = standard(spark, ("A", JAN[0], 10, 1), ("A", JAN[1], 20, 1), ("B", JAN[0], 5, 1))
    new = standard(spark, ("A", JAN[1], 30, 2), ("A", JAN[2], 60, 2)).withColumn("arrival", F.lit(0))
    again = standard(spark, ("A", JAN[2], 45, 3)).withColumn("arrival", F.lit(1))
    fresh = new.unionByName(again)
    got = rows(merge.merge_bars(old, fresh), "symbol", "date", "close", "volume", "daily_return")
    assert [(s, d, c, v) for s, d, c, v, _ in got] == [("A", JAN[0], 10.0, 1), ("A", JAN[1], 30.0, 2), ("A", JAN[2], 45.0, 3), ("B", JAN[0], 5.0, 1)]
    assert [r[4] for r in got] == [None, pytest.approx(2.0), pytest.approx(.5), None]
    report = merge.merge_report(old, fresh).where("symbol = 'A'").head()
    assert (report["existing_rows"], report["downloaded_rows"], report["merged_rows"]) == (2, 3, 3)
    assert (report["new_dates"], report["replaced_dates"], report["retained_rows"]) == (1, 1, 1)


def test_merge_order_of_rows_does_not_matter(spark):
    old = standard(spark, *[("A", d, 10 + i, 1) for i, d in enumerate(JAN)])
    new = standard(spark, ("A", JAN[3], 99, 1)).withColumn("arrival", F.lit(0))
    a = rows(merge.merge_bars(old, new))
    assert a == rows(merge.merge_bars(old.orderBy(F.desc("date")).repartition(3), new))


def test_numeric_looking_symbols_and_absent_tables(spark):
    root = scratch_path(spark, "bars")
    assert bar_io.read_bars(spark, root).count() == 0
    bar_io.write_bars(standard(spark, ("007", JAN[0], 1, 1), ("7", JAN[0], 2, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "symbol") == [("007",), ("7",)]
    one = bar_io.read_symbol(spark, root, "007")
    assert rows(one, "close") == [(1.0,)]
    assert "PartitionFilters: [isnotnull(symbol" in one._jdf.queryExecution().executedPlan().toString()


def test_requests_are_checked(spark):
    bars = standard(spark, ("A", JAN[0], 1, 1))
    pool = bars.select("symbol")
    for fields in [[], ["close", "close"], ["date"], ["nope"]]:
        with pytest.raises(ValueError):
            bar_io.read_history(bars, pool, JAN[0], JAN[1], fields)
    for fields in [[], ["daily_return"], ["dollar_volume"]]:
        with pytest.raises(ValueError):
            bar_io.read_bars_window(bars, ["A"], JAN[0], JAN[1], fields)
    with pytest.raises(ValueError):
        bar_io.read_bars_window(bars, ["A"], JAN[1], JAN[0], ["open"])
    empty = bar_io.read_bars_window(bars, [], JAN[0], JAN[1], ["open"])
    assert empty.columns == ["date", "symbol", "open"] and empty.count() == 0


def test_publish_replaces_only_its_symbols(spark):
    root = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 1, 1), ("B", JAN[0], 2, 1)), root)
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 3, 1), ("B", JAN[1], 4, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "symbol", "close") == [("A", 1.0), ("B", 3.0), ("B", 4.0)]


def test_bad_bars_are_not_published(spark):
    root = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 1, 1)), root)
    for bad in [
        standard(spark, ("A", JAN[0], -1, 1)),
        standard(spark, ("A", JAN[0], 2, 1), ("A", JAN[0], 2, 1)),
        standard(spark, ("A", JAN[0], 2, 1)).where("false"),
    ]:
        with pytest.raises(ValueError):
            bar_io.publish_bars(bad, root)
    assert rows(bar_io.read_bars(spark, root), "close") == [(1.0,)]


def test_failed_confirmation_restores_the_version_before(spark, monkeypatch):
    root = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 1, 1)), root)
    monkeypatch.setattr(bar_io, "publish_violations", lambda staged, live: contracts.flagged(live, "broken", F.col("symbol")))
    with pytest.raises(ValueError):
        bar_io.publish_bars(standard(spark, ("A", JAN[0], 9, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "close") == [(1.0,)]


def test_verify_names_every_issue(spark):
    good = standard(spark, ("A", JAN[0], 1, 1))
    assert quality.verify_dataset(good).head()["ok"]
    twice = quality.verify_dataset(good.unionByName(good)).head()
    assert (twice["ok"], twice["duplicate_rows"]) == (False, 1)
    assert quality.verify_dataset(good.where("false")).head()["issues"] == ["dataset contains 0 rows"]
    assert "missing column volume" in quality.verify_dataset(good.drop("volume")).head()["issues"]
    assert dict(rows(quality.null_counts(good.drop("low"))))["low"] == -1
    assert rows(quality.column_types(good.select("date", "volume")), "column", "type") == [("date", "date"), ("volume", "bigint")]


def test_universe_file_keeps_text(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("symbol, name ,exchange,security_type,is_active\nNA,Nano, nyse ,Common_Stock,Yes\nnull,\"N, Inc\",BATS,common_stock,0\n")
    got = universe.normalize_universe(universe.read_universe(spark, str(path)))
    assert rows(got, "symbol", "name", "exchange", "security_type", "active") == [
        ("NA", "Nano", "NYSE", "common_stock", True), ("NULL", "N, Inc", "BATS", "common_stock", False),
    ]
    path.write_text("symbol,symbol,exchange,security_type,is_active\n")
    with pytest.raises(ValueError, match="repeated"):
        universe.read_universe(spark, str(path))


def test_small_universe_and_order_numbers(spark):
    names = [f"{a}{b}" for a in "BAC" for b in "QXYZ"]
    df = universe.with_ord(spark.createDataFrame([(n,) for n in names], "symbol string"))
    assert [s for _, s in rows(df, "ord", "symbol")] == sorted(names)
    few = spark.createDataFrame([("A", "n", "NYSE", "common_stock", "1")], "symbol string, name string, exchange string, security_type string, is_active string")
    assert rows(contracts.universe_violations(universe.normalize_universe(few)), "rule") == [("universe_too_small",)]


def panel(spark, day, value, version="1"):
    return spark.createDataFrame([(day, "A", "f", version, value, True)], "as_of_date date, symbol string, factor_name string, factor_version string, raw_value double, is_eligible boolean")


def test_panel_store_replaces_single_keys(spark):
    root = scratch_path(spark, "panels")
    panel_io.write_panels(panel(spark, JAN[0], 1.0).unionByName(panel(spark, JAN[1], 2.0)), root)
    panel_io.write_panels(panel(spark, JAN[1], 5.0), root)
    panel_io.write_panels(panel(spark, JAN[1], 7.0, "2"), root)
    assert rows(panel_io.read_panels(spark, root, "f", "1"), "as_of_date", "raw_value") == [(JAN[0], 1.0), (JAN[1], 5.0)]
    assert rows(panel_io.read_panels(spark, root, "f", "1", JAN[1], JAN[3]), "raw_value") == [(5.0,)]
    wanted = panel(spark, JAN[0], 1.0, "2").select("factor_name", "factor_version", "as_of_date")
    assert panel_io.missing_keys(spark, root, wanted).count() == 1
    assert panel_io.misfiled(spark, root).count() == 0
    plan = panel_io.read_panels(spark, root, "f", "1", JAN[1], JAN[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(factor_name" in plan and "(year#" in plan.split("PartitionFilters")[1]
    assert len({f.rsplit("/", 1)[0] for f in panel_io.stored_panels(spark, root).inputFiles()}) == 2


def test_whole_panels_are_vouched_for(spark):
    root = scratch_path(spark, "panels")
    panel_io.write_panels(panel(spark, JAN[0], 1.0), root)
    dates = spark.createDataFrame([(JAN[0],), (JAN[1],)], "as_of_date date")
    with pytest.raises(ValueError, match="not stored"):
        panel_io.read_whole_panels(spark, root, "f", "1", JAN[0], JAN[3], dates)
    assert panel_io.read_whole_panels(spark, root, "f", "1", JAN[0], JAN[3], dates.limit(1)).count() == 1
    panel(spark, JAN[1], 2.0).select("symbol", "raw_value", "is_eligible", "as_of_date").write.parquet(f"{root}/factor_name=f/factor_version=1/year=1999")
    with pytest.raises(ValueError, match="unrecorded"):
        panel_io.read_whole_panels(spark, root, "f", "1", JAN[0], JAN[3])


def test_lost_moved_and_changed_panels_are_refused_in_their_range(spark):
    base = scratch_path(spark, "panels")
    old, new = date(2022, 5, 2), date(2023, 5, 2)
    for root in (f"{base}/lost", f"{base}/moved", f"{base}/changed"):
        panel_io.write_panels(panel(spark, old, 1.0).unionByName(panel(spark, new, 2.0)), root)
    folder = "factor_name=f/factor_version=1"
    bar_io.versions.remove(spark, f"{base}/lost/{folder}/year=2022")
    assert bar_io.versions.take_name(spark, f"{base}/moved/{folder}/year=2022", f"{base}/moved/{folder}/year=2021")
    file = next(n for n in bar_io.versions.names(spark, f"{base}/changed/{folder}/year=2022") if n.startswith("part-"))
    with open(f"{base}/changed/{folder}/year=2022/{file}".removeprefix("file:"), "ab") as f:
        f.write(b"more")
    for root, problem in (("lost", "missing"), ("moved", "misfiled"), ("changed", "changed")):
        found = rows(panel_io.panel_problems(spark, f"{base}/{root}"), "as_of_date", "year", "problem")
        assert found == [(old, 2022, problem)]
        with pytest.raises(ValueError, match=problem):
            panel_io.read_whole_panels(spark, f"{base}/{root}", "f", "1", old, old)
        assert panel_io.read_whole_panels(spark, f"{base}/{root}", "f", "1", new, new).count() == 1
    # writing the year again mends it
    panel_io.write_panels(panel(spark, old, 3.0), f"{base}/lost")
    assert panel_io.read_whole_panels(spark, f"{base}/lost", "f", "1", old, new).count() == 2


def test_a_factor_sees_its_dates_look_back_windows_only(spark):
    from quantloom.plans import research

    sessions = [date(2020, 1, 1) + timedelta(days=i) for i in range(1500)]
    cal = days(spark, [d.isoformat() for d in sessions])
    dates = [sessions[400], sessions[405], sessions[1100]]
    asked = spark.createDataFrame([(d,) for d in [*dates, date(2019, 1, 1)]], "as_of_date date")
    needed = rows(research.needed_sessions(asked, cal, 20))
    assert needed == [(d,) for d in sorted({s for d in dates for s in sessions[sessions.index(d) - 20:sessions.index(d) + 1]})]
    root, seen, ranges = scratch_path(spark, "bars"), [], []
    bar_io.write_bars(standard(spark, *[("A", d, 1 + i, 1) for i, d in enumerate(sessions)]), root)

    def reader(first, last):
        ranges.append((first, last))
        return bar_io.read_bars(spark, root, first, last)

    def factor(bars, todo, universe, calendar):
        seen.append(bars)
        return spark.createDataFrame([(d, "A", "f", "1", 1.0, True) for (d,) in rows(todo)], "as_of_date date, symbol string, factor_name string, factor_version string, raw_value double, is_eligible boolean")

    pool = spark.createDataFrame([("A", 1)], "symbol string, ord int")
    job = research.FactorJob(factor, "f", "1", reader, pool, cal, scratch_path(spark, "panels"), lookback=20)
    todo = spark.createDataFrame([(d,) for d in dates], "as_of_date date")
    assert {s for _, s in rows(research.factor_batch(job, todo), "as_of_date", "status")} == {"succeeded"}
    assert ranges == [(sessions[380], sessions[1100])] and rows(seen[0], "date") == needed
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 2021", plan) and re.search(r"year#\d+ <= 2023", plan)
    # all dates are stored: nothing is read or computed
    assert {o for _, o in rows(research.factor_batch(job, todo), "as_of_date", "outcome")} == {"hit"} and len(seen) == len(ranges) == 1


def test_range_reads_open_their_years_only(spark):
    root = scratch_path(spark, "bars")
    bar_io.write_bars(standard(spark, ("A", date(2022, 1, 3), 1, 1), ("A", JAN[0], 1, 1)), root)
    some = bar_io.read_bars(spark, root, JAN[0], JAN[1])
    assert rows(some, "date") == [(JAN[0],)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters")[1].split("]")[0]


def test_cache_plan_outcomes(spark):
    wanted = spark.createDataFrame([(JAN[0],), (JAN[1],)], "as_of_date date")
    held = wanted.limit(1)
    assert sorted(r[1] for r in rows(panel_io.cache_plan(wanted, held))) == ["hit", "miss"]
    assert {r[1] for r in rows(panel_io.cache_plan(wanted, held, force=True))} == {"forced"}


def test_reports_never_overwrite(spark):
    table = spark.createDataFrame([(float("nan"), 1)], "x double, n int")
    root = scratch_path(spark, "reports")
    tables = {name: table for name in reports.REPORT_TABLES}
    path = reports.write_report(root, "r1", tables, table)
    assert spark.read.text(f"{path}/metadata").head()[0] == '{"x":null,"n":1}'
    with pytest.raises(FileExistsError):
        reports.write_report(root, "r1", tables, table)
    # a report that is cut off leaves nothing under its name
    broken = table.withColumn("x", F.raise_error(F.lit("a lost job")).cast("double"))
    with pytest.raises(Exception, match="a lost job"):
        reports.write_report(root, "r2", tables | {reports.REPORT_TABLES[-1]: broken}, table)
    assert set(bar_io.versions.names(spark, root)) == {"r1", "_arriving"} and not bar_io.versions.names(spark, f"{root}/_arriving")


def test_rows_meet_only_their_own_window(spark):
    windows = spark.createDataFrame(
        [("A", JAN[1], JAN[2], "x"), ("B", JAN[0], JAN[0], "y"), ("C", None, None, None)],
        "symbol string, window_start date, window_end date, reason string",
    )
    data = spark.createDataFrame([(s, d) for s in "ABC" for d in JAN], "symbol string, date date")
    got = rows(rows_in_windows(data, windows), "symbol", "date", "plan_reason")
    assert got == [("A", JAN[1], "x"), ("A", JAN[2], "x"), ("B", JAN[0], "y")]


def test_update_keeps_going_when_a_symbol_breaks(spark):
    cal = days(spark, [d.isoformat() for d in JAN])
    root, base = scratch_path(spark, "live"), scratch_path(spark, "update")
    bar_io.write_bars(standard(spark, ("A", JAN[0], 1, 1), ("BAD", JAN[0], 1, 1)), root)
    symbols = spark.createDataFrame([("A",), ("BAD",), ("NEW",)], "symbol string")
    vendor = raw(spark, *[(s, d.isoformat(), -5 if s == "BAD" else 2 + i, 9) for s in ("A", "BAD", "NEW") for i, d in enumerate(JAN)])
    tagged = vendor.withColumn("day", F.to_date("Date"))
    got = update_bars(
        symbols, root, lambda w: rows_in_windows(tagged, w, "day").drop("day"), cal, JAN[0], JAN[3],
        run_id="r", raw_root=f"{base}/raw", log_root=f"{base}/log", overlap=1,
    )
    assert rows(got, "symbol", "status") == [("A", "success"), ("BAD", "failed"), ("NEW", "success")]
    assert rows(bar_io.read_bars(spark, root).groupBy("symbol").count()) == [("A", 4), ("BAD", 1), ("NEW", 4)]
    log = spark.read.json(f"{base}/log")
    assert log.count() == 3 and log.where("symbol = 'A'").head()["windows"][0]["reason"] == "tail_gap+overlap_refresh"


def test_stream_equals_batch(spark):
    base = scratch_path(spark, "stream")
    first = raw(spark, *[("A", d.isoformat(), 10 + i, 1) for i, d in enumerate(JAN[:3])], ("B", "soon", 1, 1))
    second = raw(spark, ("A", JAN[2].isoformat(), 50, 1), ("A", JAN[3].isoformat(), 60, 1))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(f"{base}/raw")
        incremental_bars(spark, f"{base}/raw", first.schema, f"{base}/live", f"{base}/checkpoint").awaitTermination()
    got = rows(bar_io.read_bars(spark, f"{base}/live"), "date", "close")
    assert got == [(JAN[0], 10.0), (JAN[1], 11.0), (JAN[2], 50.0), (JAN[3], 60.0)]


def test_sliced_lag_equals_the_plain_one(spark):
    from datetime import timedelta

    data = [(s, date(2021, 11, 1) + timedelta(days=37 * i), 10.0 + (i * 7) % 5, 1) for s in "AB" for i in range(30)]
    plain = standard(spark, *data)
    sliced = bar_ops.derive_features_sliced(plain.drop("daily_return", "dollar_volume"))
    assert rows(sliced, *plain.columns) == rows(plain)


def test_many_symbols_fall_back_to_a_join(spark, monkeypatch):
    root = scratch_path(spark, "bars")
    bar_io.write_bars(standard(spark, *[(f"S{i}", JAN[0], 1 + i, 1) for i in range(4)]), root)
    some = spark.createDataFrame([("S1",), ("S2",), ("GONE",)], "symbol string")
    few = rows(bar_io.rows_of_symbols(spark, root, some), "symbol")
    monkeypatch.setattr(bar_io, "PRUNE_LIMIT", 1)
    assert few == rows(bar_io.rows_of_symbols(spark, root, some), "symbol") == [("S1",), ("S2",)]


def test_large_universes_are_numbered_in_slices(spark, monkeypatch):
    names = [f"S{i:03d}" for i in range(60)]
    monkeypatch.setattr(universe, "checked_bound", lambda df: None)
    df = universe.with_ord(spark.createDataFrame([(n,) for n in reversed(names)], "symbol string"))
    assert rows(df, "ord", "symbol") == [(i + 1, n) for i, n in enumerate(names)]
