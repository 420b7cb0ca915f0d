"""Calendars, schedules and download planning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import calendar, planning, schedule
from ..plans.update import rows_in_windows
from .inputs import PLAN_END, PLAN_START, STUDY_END, STUDY_START, Market
from .registry import query


@query("session_calendar", "SELECT * FROM o_cal", dates=["session"])
def session_calendar(m: Market):
    return m.calendar


@query("sessions_in_range", """
SELECT * FROM o_bdays WHERE session BETWEEN DATE '1994-01-01' AND DATE '1997-07-04'""", dates=["session"])
def sessions_in_range(m: Market):
    return calendar.sessions_in_range(m.business_days, date(1994, 1, 1), date(1997, 7, 4))


@query("is_session", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT session FROM o_bdays)
""", dates=["day"])
def is_session(m: Market):
    orders = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return calendar.keep_sessions(orders, m.business_days, "day")


@query("off_session", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT session FROM o_bdays)""", dates=["day"])
def off_session(m: Market):
    orders = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return calendar.off_session(orders, m.business_days, "day")


@query("next_session_after", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, session AS next_session FROM orders
ASOF LEFT JOIN o_bdays ON CAST(o_orderdate AS DATE) < session""", dates=["day", "next_session"])
def next_session_after(m: Market):
    orders = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return calendar.next_session_after(orders, m.business_days, "day")


@query("weekly_schedule", "SELECT * FROM o_weekly", dates=["decision_date"])
def weekly_schedule(m: Market):
    return schedule.weekly_schedule(m.business_days, STUDY_START, STUDY_END)


@query("biweekly_schedule", """
SELECT decision_date FROM o_weekly QUALIFY row_number() OVER (ORDER BY decision_date) % 2 = 1""",
       dates=["decision_date"])
def biweekly_schedule(m: Market):
    return schedule.biweekly_schedule(m.business_days, STUDY_START, STUDY_END)


@query("monthly_schedule", "SELECT * FROM o_monthly", dates=["decision_date"])
def monthly_schedule(m: Market):
    return schedule.monthly_schedule(m.business_days, STUDY_START, STUDY_END)


@query("rebalance_schedule", "SELECT * FROM o_rebalance", dates=["decision_date", "execution_date"])
def rebalance_schedule(m: Market):
    return schedule.rebalance_schedule(m.business_days, STUDY_START, STUDY_END, delay=2)


@query("unexecuted_decisions", """
SELECT decision_date FROM o_weekly WHERE decision_date NOT IN (SELECT decision_date FROM o_rebalance)""",
       dates=["decision_date"])
def unexecuted_decisions(m: Market):
    weekly = schedule.weekly_schedule(m.business_days, STUDY_START, STUDY_END)
    events = schedule.rebalance_schedule(m.business_days, STUDY_START, STUDY_END, delay=2)
    return schedule.unexecuted_decisions(weekly, events)


@query("plan_download", "SELECT * FROM o_plan", dates=["window_start", "window_end"])
def plan_download(m: Market):
    return planning.plan_download(m.pool, m.held_dates, m.calendar, PLAN_START, PLAN_END)


@query("short_delivery", """
SELECT symbol, window_start, window_end, expected, delivered FROM (
  SELECT p.symbol, window_start, window_end,
    (SELECT count(*) FROM o_cal WHERE session BETWEEN window_start AND window_end) AS expected,
    count(b.close) AS delivered
  FROM o_plan p LEFT JOIN o_bars b ON b.symbol = p.symbol AND b.date BETWEEN window_start AND window_end
       AND dayofyear(b.date) % 5 <> 2
  GROUP BY p.symbol, window_start, window_end)
WHERE delivered < expected""", dates=["window_start", "window_end"])
def short_delivery(m: Market):
    """The vendor delivers only the more active weeks of each planned window."""
    plan = planning.plan_download(m.pool, m.held_dates, m.calendar, PLAN_START, PLAN_END)
    delivered = rows_in_windows(m.stored_bars.where("dayofyear(date) % 5 <> 2"), plan)
    return planning.short_deliveries(plan, delivered, m.calendar)
