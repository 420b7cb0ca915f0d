"""A small exchange calendar for tests: weekdays without the listed 2024 holidays."""

from datetime import date, timedelta

# Weekday closures of the New York exchange in 2024.
HOLIDAYS_2024 = [
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19",
    "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25",
]


def sessions(start, end, closed=HOLIDAYS_2024):
    day, last = date.fromisoformat(start), date.fromisoformat(end)
    shut = {date.fromisoformat(d) for d in closed}
    out = []
    while day <= last:
        if day.weekday() < 5 and day not in shut:
            out.append(day)
        day += timedelta(days=1)
    return out
