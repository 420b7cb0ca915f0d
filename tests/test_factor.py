from datetime import date

import pytest

from quantloom.operators import labels, panel

from .conftest import days, rows
from .market import sessions

ALL = sessions("2023-01-02", "2024-03-15", closed=[])
ISO = [d.isoformat() for d in ALL]


@pytest.fixture(scope="module")
def cal(spark):
    return days(spark, ISO)


def bars(spark, history):
    return spark.createDataFrame(
        [(d, s, p) for s, series in history.items() for d, p in series], "date date, symbol string, adjusted_close double"
    )


def value(spark, cal, series, as_of=ALL[252]):
    got = panel.momentum_values(bars(spark, {"A": series}), cal).where(f"as_of_date = '{as_of}'").head()
    return (None, False) if got is None else (got["raw_value"] if got["is_eligible"] else None, got["is_eligible"])


def flat(n, **changes):
    series = [[d, 50.0] for d in ALL[:n]]
    for at, price in changes.items():
        series[int(at[1:])][1] = price
    return [tuple(x) for x in series]


def test_only_the_two_anchors_matter(spark, cal):
    assert value(spark, cal, flat(253, i0=100.0, i231=130.0)) == (pytest.approx(.3), True)


@pytest.mark.parametrize("series", [
    flat(252), flat(253, i0=0.0), flat(253, i231=None), flat(253, i231=float("inf")), flat(253, i0=float("nan")),
    [x for i, x in enumerate(flat(253)) if i != 100],
])
def test_short_or_unusable_history_is_ineligible(spark, cal, series):
    assert value(spark, cal, series) == (None, False)


def test_a_missing_session_is_not_replaced_by_an_older_bar(spark, cal):
    series = [x for i, x in enumerate([(d, 50.0) for d in ALL[:260]]) if i != 100]
    assert value(spark, cal, series, ALL[259]) == (None, False)


def test_panel_is_dense_and_future_rows_do_not_matter(spark, cal):
    universe = spark.createDataFrame([("A", 1), ("GONE", 2)], "symbol string, ord bigint")
    dates = spark.createDataFrame([(ALL[252],)], "as_of_date date")
    short, longer = flat(253, i0=40.0), flat(280, i0=40.0, i260=999.0)
    got = [rows(panel.momentum()(bars(spark, {"A": s}), dates, universe, cal), "symbol", "raw_value", "is_eligible") for s in (short, longer)]
    assert got[0] == got[1] == [("A", .25, True), ("GONE", None, False)]


def test_python_factor_gets_whole_histories(spark, cal):
    def rule(history):
        out = history.sort_values("date").tail(1)[["date", "symbol", "adjusted_close"]]
        out.columns = ["as_of_date", "symbol", "raw_value"]
        return out.assign(is_eligible=True)[["as_of_date", "symbol", "raw_value", "is_eligible"]]

    universe = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, ord bigint")
    dates = spark.createDataFrame([(ALL[4],)], "as_of_date date")
    made = panel.pandas_factor(rule, "last", "1", ["adjusted_close"])
    got = rows(made(bars(spark, {"A": flat(5, i4=7.0), "B": flat(4)}), dates, universe, cal), "symbol", "raw_value")
    assert got == [("A", 7.0), ("B", None)]


def label(spark, cal, series, horizon=2, as_of=ALL[0]):
    p = spark.createDataFrame([(as_of, "A", "f", "1")], "as_of_date date, symbol string, factor_name string, factor_version string")
    return labels.forward_returns(p, bars(spark, {"A": series}), cal, horizon).head()


def test_forward_return_counts_sessions(spark, cal):
    got = label(spark, cal, [(ALL[0], 10.0), (ALL[1], 11.0), (ALL[2], 12.0)])
    assert (got["end_date"], got["forward_return"], got["is_available"]) == (ALL[2], pytest.approx(.2), True)


@pytest.mark.parametrize("series", [
    [(ALL[0], 10.0), (ALL[1], 11.0), (ALL[3], 12.0)], [(ALL[1], 10.0), (ALL[2], 11.0)],
    [(ALL[0], 0.0), (ALL[2], 11.0)], [(ALL[0], 1e-300), (ALL[2], 1e300)],
])
def test_missing_or_unusable_ends_are_unavailable(spark, cal, series):
    got = label(spark, cal, series)
    assert (got["forward_return"], got["is_available"]) == (None, False)


def test_dates_without_an_end_session_are_refused(spark, cal):
    assert label(spark, cal, flat(5), as_of=ALL[-1]) is None
    p = spark.createDataFrame([(ALL[-1],), (ALL[0],)], "as_of_date date")
    assert rows(labels.unlabelled_dates(p, cal, 2)) == [(ALL[-1],)]
    with pytest.raises(ValueError):
        labels.label_sessions(cal, 0)


def test_off_session_bars_have_no_label(spark, cal):
    saturday = date(2023, 1, 7)
    p = spark.createDataFrame([(saturday, "A", "f", "1")], "as_of_date date, symbol string, factor_name string, factor_version string")
    assert labels.forward_returns(p, bars(spark, {"A": [(saturday, 1.0)]}), cal, 1).count() == 0
