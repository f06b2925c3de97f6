"""Dates: lookback windows, fishing years, midpoints, elapsed days."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.context import ntz
from quayside.functions._col import as_col

# Fishing-year calendars and the month each one starts in.
CALENDAR_START_MONTH = {
    "JAN TO DEC": 1,
    "MAR TO FEB": 3,
    "MAY TO APR": 5,
    "NOV TO OCT": 11,
}

# Which year labels a fishing year that spans two calendar years.  The
# reference's label function has no body in the file; "start" (the year the
# fishing year begins in) is the default and can be switched per run.
FISHING_YEAR_LABEL = "start"


def lookback(c, cutoff: _dt.datetime) -> Column:
    """``day(c) >= day(as_of) - n`` written as ``c >= cutoff`` on the raw
    column so Parquet receives a pushed ``GreaterThanOrEqual``."""
    return as_col(c) >= ntz(cutoff)


def fishing_year(c, start_month: int, label: str | None = None) -> Column:
    """Fishing year of a timestamp under a calendar starting in ``start_month``."""
    d = as_col(c)
    y = F.year(d)
    if start_month == 1:
        return y
    begun = F.month(d) >= F.lit(start_month)
    if (label or FISHING_YEAR_LABEL) == "start":
        return F.when(begun, y).otherwise(y - 1)
    return F.when(begun, y + 1).otherwise(y)


def fishing_year_by_calendar(c, calendar, label: str | None = None) -> Column:
    """Fishing year where the calendar name is itself a column (per species
    plan); unknown or NULL calendar -> NULL."""
    cal = as_col(calendar)
    out = None
    for name, month in CALENDAR_START_MONTH.items():
        branch = fishing_year(c, month, label)
        out = F.when(cal == F.lit(name), branch) if out is None else out.when(cal == F.lit(name), branch)
    return out


def midpoint(start, end) -> Column:
    """``start + (end - start) / 2`` as a timestamp (day-time interval math)."""
    s = as_col(start)
    return s + (as_col(end) - s) / 2


def elapsed_days(as_of: _dt.datetime, c) -> Column:
    """Fractional days from ``c`` to the run clock (double)."""
    return F.timestamp_diff("MICROSECOND", as_col(c), ntz(as_of)).cast("double") / F.lit(86400000000.0)
