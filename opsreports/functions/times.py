"""Dates, clock slots and calendar windows.

Timestamps are stored in UTC without a zone and shown at a fixed offset. Nothing
here reads the clock: each caller passes its own ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, functions as F

LOCAL_OFFSET = dt.timedelta(hours=5, minutes=30)


def ntz(moment: dt.datetime | dt.date) -> Column:
    """A zone-free timestamp constant. Built from text, so no zone can creep in and
    a comparison with a stored column still reaches the parquet filter."""
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time())
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day(date: dt.date) -> Column:
    return F.lit(date.isoformat()).cast("date")


def _interval(span: dt.timedelta) -> Column:
    return F.expr(f"INTERVAL '{int(span.total_seconds())}' SECOND")


def local_time(ts: Column, offset: dt.timedelta = LOCAL_OFFSET) -> Column:
    return ts + _interval(offset)


def local_date(ts: Column, offset: dt.timedelta = LOCAL_OFFSET) -> Column:
    return F.to_date(local_time(ts, offset))


def sunday_week(date: Column) -> Column:
    """Week of the year, weeks starting on Sunday; days before the first are week 0."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def iso_year(date: Column) -> Column:
    """The year an ISO week belongs to: that of its Thursday."""
    return F.year(F.date_add(date, 3 - F.weekday(date)))


def month_year_label(month: Column, year: Column) -> Column:
    return F.concat_ws("-", month.cast("string"), year.cast("string"))


def month_name_label(date: Column) -> Column:
    return F.date_format(date, "MMMM-yyyy")


def parse_day_first(text: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` to a timestamp; NULL where the text does not fit."""
    return F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz")


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp."""
    return ntz(dt.datetime(1970, 1, 1)) + F.make_dt_interval(secs=(ms / 1000).cast("decimal(18,6)"))


def as_utc(ts: Column) -> Column:
    """A zone-free UTC time as an instant, whatever the session zone."""
    since = (ts - ntz(dt.datetime(1970, 1, 1))).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((since * 1_000_000).cast("bigint"))


def from_utc(instant: Column) -> Column:
    """An instant as zone-free UTC time, whatever the session zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return ntz(dt.datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds)


def age_seconds(ts: Column, as_of: dt.datetime) -> Column:
    """Seconds from ts to as_of, with their fraction."""
    gap = ntz(as_of) - ts
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def _clock_faces(padded: bool) -> Column:
    """12AM, 1AM ... 11PM and 12AM again, as one constant array."""
    faces = [f"{h % 12 or 12:0{2 if padded else 1}d}{'AM' if h < 12 else 'PM'}" for h in range(24)]
    return F.array(*[F.lit(face) for face in [*faces, faces[0]]])


def hour_label(hour: Column, padded: bool = False) -> Column:
    """0..24 to 12AM..11PM and 12AM; NULL for any other number."""
    return F.try_element_at(_clock_faces(padded), hour + 1)


def _hour_of(end: Column) -> Column:
    """Leading hour of 9:00, 09:00, 900 or 0900; NULL for any other shape."""
    return F.nullif(F.regexp_extract(end, r"^(\d{1,2}):?\d{2}$", 1), F.lit("")).cast("int")


def slot_label(slot: Column, padded: bool = False) -> Column:
    """One label for the same hour slot however it was typed.

    A slot already written with AM or PM keeps its text (zero-padded on request),
    ``None`` stays ``None``, and a text of no known shape gives NULL.
    """
    start, end = F.split_part(slot, F.lit("-"), F.lit(1)), F.split_part(slot, F.lit("-"), F.lit(2))
    typed = slot
    if padded:
        typed = F.concat_ws(
            "-",
            *[F.when(F.length(x) == 3, F.concat(F.lit("0"), x)).otherwise(x) for x in (start, end)],
        )
    made = F.concat(hour_label(_hour_of(start), padded), F.lit("-"), hour_label(_hour_of(end), padded))
    return F.when(slot == "None", slot).when(slot.contains("M"), typed).otherwise(made)


def hour_slot(ts: Column, padded: bool = False) -> Column:
    """The slot a timestamp falls in: ``9AM-10AM``."""
    hour = F.hour(ts)
    return F.concat(hour_label(hour, padded), F.lit("-"), hour_label(hour + 1, padded))


def slot_ordinal(slot: Column) -> Column:
    """Place of a slot in the day by its first hour: 0 for 12AM to 23 for 11PM, 24 for
    the slot-less row; NULL for a label outside the day."""
    start = F.split_part(slot, F.lit("-"), F.lit(1))
    face = F.regexp_extract(start, r"^0?(\d{1,2})(?:AM|PM)$", 1)
    hour = F.when(face != "", face.cast("int") % 12 + F.when(start.endswith("PM"), 12).otherwise(0))
    return F.when(slot == "None", F.lit(24)).otherwise(hour)


class Window(NamedTuple):
    """A named range of days, both ends kept."""

    name: str
    start: dt.date
    end: dt.date


def _month_start(date: dt.date) -> dt.date:
    return date.replace(day=1)


def day_windows(as_of: dt.date, n: int = 4) -> list[Window]:
    """d1..dn: the n days before as_of, and mtd: month start to as_of."""
    days = [as_of - dt.timedelta(days=k) for k in range(1, n + 1)]
    out = [Window(f"d{k}", d, d) for k, d in enumerate(days, 1)]
    return out + [Window("mtd", _month_start(as_of), as_of)]


def week_windows(as_of: dt.date, n: int = 4) -> list[Window]:
    """w0..w(n-1): this Monday-to-Sunday week and the ones before it."""
    monday = as_of - dt.timedelta(days=as_of.weekday())
    starts = [monday - dt.timedelta(weeks=k) for k in range(n)]
    return [Window(f"w{k}", s, s + dt.timedelta(days=6)) for k, s in enumerate(starts)]


def calendar_windows(as_of: dt.date) -> list[Window]:
    """Reporting windows as seen on as_of, whose last full day is yesterday."""
    yesterday = as_of - dt.timedelta(days=1)
    month = _month_start(yesterday)
    last_end = month - dt.timedelta(days=1)
    last = _month_start(last_end)
    earlier_end = last - dt.timedelta(days=1)
    monday = as_of - dt.timedelta(days=as_of.weekday())
    return [
        Window("month_to_date", month, yesterday),
        Window("last_month", last, last_end),
        Window("two_months_ago", _month_start(earlier_end), earlier_end),
        Window("last_week", monday - dt.timedelta(days=7), monday - dt.timedelta(days=1)),
        Window("this_week", monday, yesterday),
        Window("trailing_week", yesterday - dt.timedelta(days=7), yesterday),
        Window("yesterday", yesterday, yesterday),
    ]


def pick_windows(as_of: dt.date, *names: str) -> list[Window]:
    known = {w.name: w for w in calendar_windows(as_of)}
    return [known[name] for name in names]
