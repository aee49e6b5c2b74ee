"""Date expressions. The clock is always an argument, never read inside."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def week_of(ts: Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", ts).cast("date")


def period_of(ts: Column, unit: str) -> Column:
    """Start of the day, week, month or year, as a date."""
    return F.date_trunc(unit, ts).cast("date")


def clock(as_of: dt.datetime | str | None = None) -> Column:
    """The run's clock: the given moment, or the current one."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")  # without a zone: read in the session zone
    return F.lit(as_of).cast("timestamp")
