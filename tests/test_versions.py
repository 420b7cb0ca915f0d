"""Publishing in versions: readers in between, failures at every step, two publishers, vacuum; quarantine and ledger of the stream."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quantloom.plans.update import update_bars
from quantloom.session import scratch_path
from quantloom.sources import bars as bar_io
from quantloom.sources import versions
from quantloom.streaming.incremental import fold_batch, incremental_bars, incremental_rejects, quarantined

from .conftest import days, rows
from .test_bars import JAN, raw, standard

A1 = ("A", JAN[0], 1, 1)


def closes(spark, root, **at):
    return rows(bar_io.read_bars(spark, root, **at), "symbol", "date", "close")


@pytest.fixture
def root(spark):
    path = scratch_path(spark, "live")
    bar_io.publish_bars(standard(spark, A1, ("B", JAN[0], 2, 1)), path)
    return path


def test_a_reader_that_has_begun_keeps_its_rows(spark, root):
    begun = bar_io.read_bars(spark, root)
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 3, 1), ("B", JAN[1], 4, 1)), root)
    assert rows(begun, "symbol", "close") == [("A", 1.0), ("B", 2.0)]
    assert closes(spark, root) == [("A", JAN[0], 1.0), ("B", JAN[0], 3.0), ("B", JAN[1], 4.0)]
    assert closes(spark, root, snapshot=1) == [("A", JAN[0], 1.0), ("B", JAN[0], 2.0)]
    with pytest.raises(ValueError):
        bar_io.read_bars(spark, root, snapshot=7)


@pytest.mark.parametrize("step", ["write_bars", "_sound", "_confirmed", "take_name", "key_rows"])
def test_a_failure_at_any_step_changes_nothing(spark, root, monkeypatch, step):
    seen = []

    def broken(*args):
        seen.append(closes(spark, root))
        raise RuntimeError("a lost job")

    monkeypatch.setattr(bar_io if hasattr(bar_io, step) else versions, step, broken)
    with pytest.raises(RuntimeError, match="a lost job"):
        bar_io.publish_bars(standard(spark, ("A", JAN[0], 9, 1), ("NEW", JAN[0], 9, 1)), root)
    before = [("A", JAN[0], 1.0), ("B", JAN[0], 2.0)]
    assert seen == [before] and closes(spark, root) == before and versions.numbers(spark, root) == [1]
    # nothing is left behind
    assert len(versions.names(spark, f"{root}/data")) == 1 and not versions.names(spark, f"{root}/pending")


def test_bad_rows_are_never_live(spark, root):
    with pytest.raises(ValueError):
        bar_io.publish_bars(standard(spark, ("A", JAN[0], -1, 1)), root)
    with pytest.raises(ValueError, match="no bars"):
        bar_io.publish_bars(standard(spark, A1).where("false"), root)
    assert versions.numbers(spark, root) == [1]


def test_two_publishers(spark, root, monkeypatch):
    """The second one finds its number taken: it goes on if the first replaced other symbols, and gives up if the same."""
    real, other = versions.take_name, []

    def late(spark_, source, target):
        if other:
            bar_io.publish_bars(other.pop(), root)
        return real(spark_, source, target)

    monkeypatch.setattr(versions, "take_name", late)
    other.append(standard(spark, ("B", JAN[0], 5, 1)))
    bar_io.publish_bars(standard(spark, ("A", JAN[0], 6, 1)), root)
    assert closes(spark, root) == [("A", JAN[0], 6.0), ("B", JAN[0], 5.0)] and versions.numbers(spark, root) == [1, 2, 3]
    other.append(standard(spark, ("A", JAN[0], 7, 1)))
    with pytest.raises(versions.PublishConflict):
        bar_io.publish_bars(standard(spark, ("A", JAN[0], 8, 1)), root)
    assert closes(spark, root) == [("A", JAN[0], 7.0), ("B", JAN[0], 5.0)]


def test_names_are_taken_once(spark):
    base = scratch_path(spark, "names")
    for k in (1, 2):
        spark.range(1).write.parquet(f"{base}/from{k}")
    assert versions.take_name(spark, f"{base}/from1", f"{base}/to/x")
    assert not versions.take_name(spark, f"{base}/from2", f"{base}/to/x")
    assert set(versions.names(spark, f"{base}/to")) == {"x"} and "from2" in versions.names(spark, base)


def test_years_keys_and_whole_versions_are_replaced(spark):
    root = scratch_path(spark, "live")
    first = [(s, date(y, 1, 3), y - 2000, 1) for s in "ABC" for y in (2020, 2021)]
    bar_io.publish_bars(standard(spark, *first), root)
    bar_io.publish_bars(standard(spark, ("A", date(2020, 1, 3), 50, 1)), root)
    bar_io.publish_bars(standard(spark, ("B", date(2020, 1, 3), 51, 1), ("C", date(2020, 1, 3), 52, 1), ("C", date(2021, 1, 3), 53, 1)), root)
    assert rows(bar_io.read_bars(spark, root), "symbol", "close") == [("A", 50.0), ("B", 51.0), ("C", 52.0), ("C", 53.0)]
    state = versions.Snapshot.at(spark, root, 3)
    assert len(state.live) == 2 and not state.years and not state.has_replaced  # all of the first version is gone
    assert versions.damaged_keys(spark, root).count() == 0


def test_many_versions_become_one(spark, root, monkeypatch):
    monkeypatch.setattr(versions, "MAX_VERSIONS", 2)
    bar_io.publish_bars(standard(spark, ("C", JAN[0], 3, 1)), root)
    bar_io.publish_bars(standard(spark, ("D", JAN[0], 4, 1)), root)
    assert len(versions.Snapshot.at(spark, root, 3).live) == 1
    assert [c for *_, c in closes(spark, root)] == [1.0, 2.0, 3.0, 4.0]
    assert [c for *_, c in closes(spark, root, snapshot=2)] == [1.0, 2.0, 3.0]


def test_vacuum_keeps_what_is_needed(spark, root):
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 3, 1)), root)
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 4, 1)), root)
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 5, 1)), root)
    standard(spark, A1).write.parquet(f"{root}/data/version=00000009-lost")
    assert len(versions.vacuum(spark, root, keep=2)) == 1  # the one of snapshot 2; A of snapshot 1 is live, the lost one may be under way
    assert closes(spark, root) == [("A", JAN[0], 1.0), ("B", JAN[0], 5.0)]
    assert closes(spark, root, snapshot=3) == [("A", JAN[0], 1.0), ("B", JAN[0], 4.0)]
    assert versions.ledger(spark, root).count() == 4
    assert versions.vacuum(spark, root, keep=1, leftover_hours=-1) and closes(spark, root) == [("A", JAN[0], 1.0), ("B", JAN[0], 5.0)]


def test_unversioned_tables_are_taken_over(spark):
    root = scratch_path(spark, "live")
    bar_io.write_bars(standard(spark, A1, ("B", JAN[0], 2, 1)), root)
    bar_io.publish_bars(standard(spark, ("B", JAN[0], 3, 1)), root)
    assert closes(spark, root) == [("A", JAN[0], 1.0), ("B", JAN[0], 3.0)]
    versions.vacuum(spark, root, keep=1)
    assert not any(n.startswith("symbol=") for n in versions.names(spark, root))
    assert closes(spark, root) == [("A", JAN[0], 1.0), ("B", JAN[0], 3.0)]


def test_damage_is_found(spark, root):
    bar_io.publish_bars(standard(spark, ("C", JAN[0], 3, 1), ("C", date(2023, 1, 3), 3, 1), ("D", JAN[0], 3, 1)), root)
    live = versions.Snapshot.at(spark, root, 2).live[-1]
    versions.remove(spark, f"{root}/data/version={live}/symbol=C/year=2023")
    bar = standard(spark, ("D", JAN[0], 99, 1)).drop("symbol")
    bar.write.mode("overwrite").parquet(f"{root}/data/version={live}/symbol=D/year=2024")
    assert rows(versions.damaged_keys(spark, root), "symbol", "year", "problem") == [("C", 2023, "missing"), ("D", 2024, "changed")]


# -- stream ---------------------------------------------------------------
def drain(spark, base, *parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{base}/raw")
        incremental_bars(spark, f"{base}/raw", part.schema, f"{base}/live", f"{base}/checkpoint", name="vendor").awaitTermination()
    return f"{base}/live"


def test_no_good_row_is_lost_and_no_bad_price_stops_others(spark):
    base = scratch_path(spark, "stream")
    first = raw(spark, ("A", "2024-01-03", 1, 1), ("A", "2024-01-04", 2, 1), ("A", "soon", 1, 1), ("B", "2024-01-03", 1, 1), ("C", "2024-01-03", -1, 1), ("C", "2024-01-04", 5, 1))
    live = drain(spark, base, first)
    assert closes(spark, live) == [("B", JAN[1], 1.0)]
    held = incremental_rejects(spark, live)
    assert rows(held.select("symbol", F.col("date").cast("string").alias("d"), F.array_join("reasons", ",").alias("r")))[:2] == [("A", None, "unparseable_date"), ("A", "2024-01-03", "")]
    assert held.where("symbol = 'C' and array_contains(reasons, 'close_not_positive')").count() == 1 and held.count() == 5
    assert '"Date":"soon"' in held.where("date is null").head()["raw"]
    # A comes with a new day, C with the day that was wrong
    live = drain(spark, base, raw(spark, ("A", "2024-01-05", 3, 1), ("C", "2024-01-03", 4, 1)))
    assert closes(spark, live) == [("A", JAN[1], 1.0), ("A", JAN[2], 2.0), ("A", JAN[3], 3.0), ("B", JAN[1], 1.0), ("C", JAN[1], 4.0), ("C", JAN[2], 5.0)]
    assert rows(quarantined(spark, live).groupBy("symbol", "outcome").count()) == [("A", "held", 1), ("A", "readmitted", 2), ("C", "corrected", 1), ("C", "readmitted", 1)]
    assert rows(versions.ledger(spark, live), "number", "token") == [(1, "vendor#0"), (2, "vendor#1")]


def placed(spark, part, micros, name="f"):
    return part.coalesce(1).withColumns({
        "modified_": F.timestamp_micros(F.lit(micros)), "file_": F.lit(name), "row_": F.monotonically_increasing_id()})


def test_replays_and_late_deliveries(spark):
    live = scratch_path(spark, "live")
    assert fold_batch(placed(spark, raw(spark, ("A", "2024-01-03", 5, 1), ("A", "2024-01-04", 5, 1)), 2_000_000), live, "b1")
    assert not fold_batch(placed(spark, raw(spark, ("A", "2024-01-03", 9, 1)), 3_000_000), live, "b1")
    # delivered before b1, folded after it: only the day that b1 lacks is new
    assert fold_batch(placed(spark, raw(spark, ("A", "2024-01-03", 1, 1), ("A", "2024-01-02", 1, 1)), 1_000_000), live, "b0")
    assert closes(spark, live) == [("A", JAN[0], 1.0), ("A", JAN[1], 5.0), ("A", JAN[2], 5.0)]


def test_a_batch_that_fails_is_done_afresh(spark, monkeypatch):
    live = scratch_path(spark, "live")
    batch = placed(spark, raw(spark, ("A", "2024-01-03", 5, 1), ("B", "soon", 5, 1)), 2_000_000)

    def broken(*args):
        raise RuntimeError("a lost job")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "take_name", broken)
        with pytest.raises(RuntimeError):
            fold_batch(batch, live, "b1")
    assert not versions.applied(spark, live, "b1") and incremental_rejects(spark, live).count() == 0
    assert fold_batch(batch, live, "b1") and incremental_rejects(spark, live).count() == 1


# -- batch job --------------------------------------------------------------
def test_a_run_is_applied_once_and_goes_on_from_what_landed(spark, monkeypatch):
    root, base = scratch_path(spark, "live"), scratch_path(spark, "update")
    fetched = []

    def run(close):
        def fetch(windows):
            fetched.append(close)
            return raw(spark, *[("A", d.isoformat(), close, 1) for d in JAN[:3]], ("B", "soon", 1, 1))

        return update_bars(
            spark.createDataFrame([("A",), ("B",)], "symbol string"), root, fetch, days(spark, [d.isoformat() for d in JAN]), JAN[0], JAN[3],
            run_id="r", raw_root=f"{base}/raw", log_root=f"{base}/log", overlap=1)

    def broken(*args):
        raise RuntimeError("a lost job")

    with monkeypatch.context() as patch:
        patch.setattr(bar_io, "_confirmed", broken)
        with pytest.raises(RuntimeError):
            run(4)
    first = rows(run(5), "symbol", "status", "short_windows")
    assert first == [("A", "success", 1), ("B", "failed", 1)] and fetched == [4]
    assert rows(run(6), "symbol", "status", "short_windows") == first and fetched == [4]
    assert [c for *_, c in closes(spark, root)] == [4.0, 4.0, 4.0]
    window = spark.read.json(f"{base}/log").where("symbol = 'A'").head()["windows"][0]
    assert (window["expected"], window["delivered"]) == (4, 3)


def test_results_have_closed_columns_and_one_identity(spark):
    from quantloom.operators import contracts

    grid = spark.createDataFrame([(JAN[0], "A", 1), (JAN[0], "B", 2)], "as_of_date date, symbol string, ord int")
    rules = lambda found: sorted({(r["rule"], r["key"]) for r in found.collect()})
    panel = grid.select("*", F.lit("f").alias("factor_name"), F.lit("1").alias("factor_version"), F.lit(1.0).alias("raw_value"), F.lit(True).alias("is_eligible"))
    assert rules(contracts.panel_violations(panel, grid)) == []
    assert rules(contracts.panel_violations(panel.withColumn("price", F.lit(1.0)), grid)) == [("column_unexpected", "price")]
    assert rules(contracts.panel_violations(panel.drop("raw_value"), grid)) == [("column_missing", "raw_value")]
    label = panel.select("as_of_date", F.lit(JAN[1]).alias("end_date"), "symbol", F.when(F.col("symbol") == "A", "f").otherwise("G!").alias("factor_name"), "factor_version",
                         F.lit(1).cast("long").alias("horizon_sessions"), F.lit(0.1).alias("forward_return"), F.lit(True).alias("is_available"))
    assert rules(contracts.label_violations(label, grid)) == [("name_malformed", "2024-01-02|B"), ("several_identities", "2024-01-02")]
    result = grid.select("*", F.lit("s").alias("strategy_name"), F.lit("1").alias("strategy_version"), F.lit(1.0).alias("score"), F.col("ord").alias("rank"), F.lit(True).alias("is_selected"))
    assert rules(contracts.strategy_violations(result, grid)) == []
    assert rules(contracts.strategy_violations(result.withColumn("side", F.lit("BUY")), grid)) == [("column_forbidden", "side")]
    two = result.withColumn("strategy_version", F.col("symbol"))
    assert rules(contracts.strategy_violations(two, grid)) == [("several_identities", "2024-01-02")]
