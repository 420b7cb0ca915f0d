import random
from datetime import date, timedelta

import pytest

from quantloom.operators import planning

from .conftest import days, rows
from .market import HOLIDAYS_2024, sessions

D = date.fromisoformat
CLOSED = HOLIDAYS_2024 + ["2026-01-01", "2026-01-19", "2026-02-16", "2026-04-03", "2026-05-25", "2026-06-19", "2026-07-03", "2026-09-07"]
ALL = sessions("2022-01-03", "2026-12-31", CLOSED)


@pytest.fixture(scope="module")
def cal(spark):
    return days(spark, [d.isoformat() for d in ALL])


def plan(spark, cal, held, start, end, overlap=5):
    symbols = spark.createDataFrame([(s,) for s in held], "symbol string")
    published = spark.createDataFrame([(s, d) for s, ds in held.items() for d in ds], "symbol string, date date")
    return rows(planning.plan_download(symbols, published, cal, D(start), D(end), overlap))


def between(start, end, without=()):
    return [d for d in ALL if D(start) <= d <= D(end) and d.isoformat() not in without]


def test_overlap_and_tail_become_one_window(spark, cal):
    got = plan(spark, cal, {"A": between("2026-01-02", "2026-09-28")}, "2026-01-02", "2026-09-30")
    assert got == [("A", "planned", D("2026-09-24"), D("2026-09-30"), "overlap_refresh+tail_gap")]


def test_a_gap_over_a_weekend_is_one_run(spark, cal):
    held = between("2024-01-02", "2024-01-31", ("2024-01-05", "2024-01-08"))
    got = plan(spark, cal, {"A": held}, "2024-01-02", "2024-01-31", overlap=0)
    assert got == [("A", "planned", D("2024-01-05"), D("2024-01-08"), "internal_gap")]


def test_head_gap_and_refresh_stay_apart(spark, cal):
    got = plan(spark, cal, {"A": between("2024-06-03", "2024-12-31")}, "2024-01-02", "2024-12-31")
    assert got == [
        ("A", "planned", D("2024-01-02"), D("2024-05-31"), "head_gap"),
        ("A", "planned", D("2024-12-24"), D("2024-12-31"), "overlap_refresh"),
    ]


def test_new_symbol_asks_for_the_requested_range(spark, cal):
    assert plan(spark, cal, {" new ": []}, "2022-02-05", "2022-02-28") == [
        ("NEW", "planned", D("2022-02-05"), D("2022-02-28"), "initial_backfill")
    ]


def test_symbols_without_a_window_say_why(spark, cal):
    full = between("2024-01-02", "2024-01-31")
    assert plan(spark, cal, {"A": full}, "2024-01-02", "2024-01-31", overlap=0) == [("A", "up_to_date", None, None, None)]
    assert plan(spark, cal, {"A": full, "B": []}, "2024-01-06", "2024-01-07") == [
        ("A", "no_sessions", None, None, None), ("B", "no_sessions", None, None, None),
    ]


def by_hand(held, start, end, overlap):
    """The rules session by session, for one symbol with something published."""
    window = [d for d in ALL if start <= d <= end]
    lo, hi, have = min(held), max(held), set(held)
    reason = {}
    for d in window:
        if d not in have:
            reason[d] = "head_gap" if d < lo else "tail_gap" if d > hi else "internal_gap"
    wins = []
    for kind in ("head_gap", "internal_gap", "tail_gap"):
        run = []
        for d in window + [None]:
            if d is not None and reason.get(d) == kind:
                run.append(d)
            elif run:
                wins.append([run[0], run[-1], [kind]])
                run = []
    if overlap and window:
        last = [d for d in ALL if d <= end][-overlap:]
        last = [d for d in last if d >= start]
        wins.append([last[0], last[-1], ["overlap_refresh"]])
    wins.sort(key=lambda w: (w[0], w[1]))
    out = []
    for w in wins:
        after = next((d for d in ALL if d > out[-1][1]), None) if out else None
        if out and (w[0] <= out[-1][1] or (after and w[0] <= after)):
            out[-1][1] = max(out[-1][1], w[1])
            out[-1][2] += [r for r in w[2] if r not in out[-1][2]]
        else:
            out.append(w)
    return [(a, b, "+".join(r)) for a, b, r in out]


def test_random_histories_match_the_rules_by_hand(spark, cal):
    rng, held = random.Random(11), {}
    pool = between("2023-06-01", "2024-08-30")
    for n in range(40):
        a, b = sorted(rng.sample(range(len(pool)), 2))
        picked = [d for d in pool[a:b + 1] if rng.random() > rng.choice([.02, .3, .9])] or [pool[a]]
        # vendors also publish days the exchange was shut
        if rng.random() < .5:
            picked.append(picked[0] - timedelta(days=rng.randint(1, 4)))
            picked.append(picked[-2] + timedelta(days=rng.randint(1, 4)))
        held[f"S{n:02d}"] = sorted(set(picked))
    start, end = "2023-09-02", "2024-06-23"
    got = plan(spark, cal, held, start, end)
    for symbol, ds in held.items():
        mine = [r[2:] for r in got if r[0] == symbol]
        assert mine == by_hand(ds, D(start), D(end), 5), symbol


def test_missing_sessions_by_kind(spark, cal):
    published = spark.createDataFrame([("A", D("2024-01-03")), ("A", D("2024-01-05"))], "symbol string, date date")
    got = rows(planning.missing_sessions(published, cal, D("2024-01-01"), D("2024-01-08")), "session", "reason")
    assert got == [(D("2024-01-02"), "head_gap"), (D("2024-01-04"), "internal_gap"), (D("2024-01-08"), "tail_gap")]


def test_short_delivery_counts_sessions(spark, cal):
    windows = spark.createDataFrame(
        [("A", D("2024-01-01"), D("2024-01-07")), ("B", D("2024-01-02"), D("2024-01-03"))],
        "symbol string, window_start date, window_end date",
    )
    landed = spark.createDataFrame(
        [("A", D("2024-01-01")), ("B", D("2024-01-02")), ("B", D("2024-01-02"))], "symbol string, window_start date"
    )
    assert rows(planning.short_deliveries(windows, landed, cal), "symbol", "expected", "delivered") == [("A", 4, 1)]
