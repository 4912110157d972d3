"""Period bounds, elapsed days and calendar truncation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000
Day = str | dt.date

# How the last day of a period is bounded.
END_OF_DAY = "day"  # the whole last day, half-open
LAST_SECOND = "second"  # up to 23:59:59 sharp, losing the fraction after it
MIDNIGHT = "midnight"  # up to 00:00 of the last day only


def _as_date(day: Day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day[:10])


def instant(day: Day, clock: str = "00:00:00") -> Column:
    """A timestamp literal in the session time zone."""
    return F.lit(f"{_as_date(day).isoformat()} {clock}").cast("timestamp")


def at_or_after(ts: Column, start: Day) -> Column:
    return ts >= instant(start)


def up_to(ts: Column, end: Day, bound: str = END_OF_DAY) -> Column:
    if bound == END_OF_DAY:
        return ts < instant(_as_date(end) + dt.timedelta(days=1))
    if bound == LAST_SECOND:
        return ts <= instant(end, "23:59:59")
    if bound == MIDNIGHT:
        return ts <= instant(end)
    raise ValueError(f"unknown end bound {bound!r}")


def within(ts: Column, start: Day | None, end: Day | None, bound: str = END_OF_DAY) -> Column:
    """Inside [start, end]; an omitted side is open."""
    test = F.lit(True)
    if start is not None:
        test = at_or_after(ts, start)
    if end is not None:
        test = test & up_to(ts, end, bound)
    return test


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed days with fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MICROS_PER_DAY))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Completed days, for a gap that is never negative."""
    return F.floor(days_between(later, earlier)).cast("long")


def day_number(ts: Column) -> Column:
    """Fixed 24-hour slots since 1970, independent of any time zone."""
    return F.floor(F.unix_micros(ts) / F.lit(float(MICROS_PER_DAY))).cast("int")


def slot_number(ts: Column, days: int) -> Column:
    """Fixed slots of ``days`` days."""
    return F.floor(F.unix_micros(ts) / F.lit(float(MICROS_PER_DAY * days))).cast("int")


def period_start(ts: Column, grain: str) -> Column:
    """First day of the enclosing day, week (Monday) or month."""
    if grain == "day":
        return F.to_date(ts)
    if grain in ("week", "month"):
        return F.to_date(F.date_trunc(grain, ts))
    raise ValueError(f"unknown grain {grain!r}")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_from_sunday(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")
