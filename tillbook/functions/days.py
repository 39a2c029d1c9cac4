"""Driver-side day handling: validation, ranges, bronze file names.

A malformed day would raise ``CAST_INVALID_INPUT`` in the middle of a job
under ANSI mode, so days are parsed here first and only typed ``DATE``
literals reach Spark.
"""

from __future__ import annotations

import datetime as dt


def as_date(day: str | dt.date | dt.datetime) -> dt.date:
    """A ``YYYY-MM-DD`` string (or date) as a date; raises ValueError otherwise."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    try:
        return dt.date.fromisoformat(str(day).strip())
    except ValueError as e:
        raise ValueError(f"not a day in YYYY-MM-DD form: {day!r}") from e


def day_str(day) -> str:
    return as_date(day).isoformat()


def file_day(day) -> str:
    """Day as it appears in bronze file names: dashes become underscores."""
    return day_str(day).replace("-", "_")


def day_range(lo, hi) -> list[dt.date]:
    """Every day from ``lo`` to ``hi``, both included, oldest first."""
    lo, hi = as_date(lo), as_date(hi)
    if hi < lo:
        raise ValueError(f"empty range {lo} .. {hi}")
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def last_days(n: int, today: dt.date | None = None) -> list[dt.date]:
    """The last ``n`` days, today first (the reference scripts' manual run)."""
    today = today or dt.date.today()
    return [today - dt.timedelta(days=i) for i in range(n)]
