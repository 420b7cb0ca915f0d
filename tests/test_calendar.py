from datetime import date

import pytest

from quantloom.operators import calendar, schedule

from .conftest import days, rows
from .market import sessions

D = date.fromisoformat


@pytest.fixture(scope="module")
def year(spark):
    return days(spark, [d.isoformat() for d in sessions("2023-12-01", "2024-12-31")])


def decisions(df):
    return [r[0].isoformat() for r in rows(df, "decision_date")]


def test_holiday_week_moves_to_the_session_before(year):
    got = decisions(schedule.weekly_schedule(year, D("2024-11-25"), D("2024-11-29")))
    assert got == ["2024-11-27"]


def test_first_week_of_january_biweekly(year):
    got = decisions(schedule.biweekly_schedule(year, D("2024-01-01"), D("2024-01-31")))
    assert got == ["2024-01-04", "2024-01-18"]


def test_anchor_after_the_end_selects_nothing(year):
    assert decisions(schedule.weekly_schedule(year, D("2024-03-04"), D("2024-03-05"), "THU")) == []


def test_probe_in_a_closed_week_may_fall_before_the_window(spark):
    closed = days(spark, ["2024-03-08", "2024-03-18"])
    assert decisions(schedule.weekly_schedule(closed, D("2024-03-11"), D("2024-03-15"))) == []
    assert decisions(schedule.weekly_schedule(closed, D("2024-03-08"), D("2024-03-15"))) == ["2024-03-08"]


def test_probes_past_the_calendar_are_skipped(spark):
    short = days(spark, ["2024-03-04", "2024-03-05"])
    assert decisions(schedule.weekly_schedule(short, D("2024-03-01"), D("2024-04-30"))) == []


def test_month_cut_by_the_window_is_dropped(year):
    got = decisions(schedule.monthly_schedule(year, D("2024-02-01"), D("2024-03-27")))
    assert got == ["2024-02-29"]


def test_good_friday_executes_on_monday(year):
    got = rows(schedule.rebalance_schedule(year, D("2024-03-25"), D("2024-04-05")))
    assert (D("2024-03-28"), D("2024-04-01")) in got


def test_thanksgiving_executes_on_friday(year):
    got = rows(schedule.rebalance_schedule(year, D("2024-11-25"), D("2024-11-30")))
    assert got == [(D("2024-11-27"), D("2024-11-29"))]


def test_decision_without_room_stays_unexecuted(year):
    weekly = schedule.weekly_schedule(year, D("2024-11-18"), D("2024-11-28"))
    events = schedule.rebalance_schedule(year, D("2024-11-18"), D("2024-11-28"))
    assert decisions(schedule.unexecuted_decisions(weekly, events)) == ["2024-11-27"]


@pytest.mark.parametrize("call", [
    lambda c: schedule.decision_schedule(c, D("2024-02-02"), D("2024-02-01")),
    lambda c: schedule.rebalance_schedule(c, D("2024-02-01"), D("2024-02-28"), delay=0),
])
def test_impossible_requests_are_refused(year, call):
    with pytest.raises(ValueError):
        call(year)


def test_lookups_around_sessions(spark, year):
    probes = spark.createDataFrame(
        [(D("2024-03-29"),), (D("2024-03-28"),), (D("2023-11-01"),), (D("2024-12-31"),)], "day date"
    )
    before = dict(rows(calendar.session_on_or_before(probes, year, "day"), "day", "session"))
    after = dict(rows(calendar.next_session_after(probes, year, "day"), "day", "next_session"))
    assert before[D("2024-03-29")] == before[D("2024-03-28")] == D("2024-03-28")
    assert before[D("2023-11-01")] is None
    assert after[D("2024-03-28")] == D("2024-04-01")
    assert after[D("2023-11-01")] == D("2023-12-01")
    assert after[D("2024-12-31")] is None


def test_last_sessions_are_the_most_recent(year):
    got = rows(calendar.last_sessions(year, D("2024-03-31"), 2), "session")
    assert got == [(D("2024-03-27"),), (D("2024-03-28"),)]
