"""Row predicates.

Each returns a Column, so that several combine with ``&`` into one filter. Time
predicates compare the bare column with a constant; a shift by the local offset
goes to the constant, which lets parquet skip row groups by their statistics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from opsreports.functions.times import LOCAL_OFFSET, ntz


def between_local_dates(
    ts: Column, first: dt.date, last: dt.date, offset: dt.timedelta = LOCAL_OFFSET
) -> Column:
    """Local calendar date of a UTC timestamp lies in first..last."""
    start = dt.datetime.combine(first, dt.time()) - offset
    end = dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1) - offset
    return (ts >= ntz(start)) & (ts < ntz(end))


def between_dates(ts: Column, first: dt.date, last: dt.date) -> Column:
    """Date part of a timestamp lies in first..last, no shift."""
    return between_local_dates(ts, first, last, dt.timedelta(0))


def trailing_window(ts: Column, as_of: dt.datetime, older: dt.timedelta, newer: dt.timedelta) -> Column:
    """[as_of - older, as_of - newer)."""
    return (ts >= ntz(as_of - older)) & (ts < ntz(as_of - newer))


def within_last(ts: Column, as_of: dt.datetime, span: dt.timedelta) -> Column:
    """(as_of - span, as_of]."""
    return (ts > ntz(as_of - span)) & (ts <= ntz(as_of))


def previous_hour(ts: Column, as_of: dt.datetime) -> Column:
    """The whole clock hour before the one as_of is in."""
    hour = as_of.replace(minute=0, second=0, microsecond=0)
    return trailing_window(ts, hour, dt.timedelta(hours=1), dt.timedelta(0))


def due_before(ts: Column, as_of: dt.datetime) -> Column:
    return ts < ntz(as_of)


def min_age_days(ts: Column, as_of: dt.datetime, days: int = 1) -> Column:
    """At least so many whole days old."""
    return ts <= ntz(as_of - dt.timedelta(days=days))


def not_pair(first: Column, first_value, second: Column, second_value) -> Column:
    """Drops the rows where both columns hold the given values; NULL is no match."""
    return ~(first.eqNullSafe(F.lit(first_value)) & second.eqNullSafe(F.lit(second_value)))


def differs(column: Column, value) -> Column:
    """Not equal, a NULL cell counted as different (the frame rule, not the SQL one)."""
    return ~column.eqNullSafe(F.lit(value))


def not_among(column: Column, *values) -> Column:
    """In none of the values, a NULL cell kept (the frame rule, not the SQL one)."""
    return column.isNull() | ~column.isin(*values)


def non_blank(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def matches(text: Column, pattern: str) -> Column:
    """The pattern occurs somewhere in the text."""
    return text.rlike(pattern)
