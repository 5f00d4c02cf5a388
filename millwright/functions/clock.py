"""Plant-local time arithmetic on ``timestamp_ntz`` columns.

Business time is naive local time, so nothing here depends on the session time zone:
whole seconds are derived from the date and the wall-clock fields.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400

AsOf = str | dt.date | dt.datetime | Column


def ntz(value: AsOf) -> Column:
    """A literal or column as ``timestamp_ntz``; every rolling window gets its "now" this way."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: AsOf) -> Column:
    return ntz(value).cast("date")


def days_before(as_of: AsOf, days: int) -> Column:
    """Midnight ``days`` days before the as-of date."""
    return F.date_sub(day(as_of), days).cast("timestamp_ntz")


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def clock_seconds(text: Column) -> Column:
    """``HH:mm:ss`` text as seconds since midnight."""
    part = [F.try_element_at(F.split(text, ":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + F.coalesce(part[2], F.lit(0))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds (floor) since 1970-01-01 of a naive timestamp."""
    return F.unix_date(ts.cast("date")).cast("bigint") * DAY + seconds_of_day(ts)


def epoch_seconds_up(ts: Column) -> Column:
    """Whole seconds, rounded up: ``ts > s`` for an integer ``s`` is ``epoch_seconds_up(ts) > s``."""
    return epoch_seconds(ts) + F.when(F.extract(F.lit("SECOND"), ts) % 1 > 0, 1).otherwise(0)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second *boundaries* crossed from start to end (not elapsed seconds)."""
    return epoch_seconds(end) - epoch_seconds(start)


def round_to_second(ts: Column) -> Column:
    """Nearest whole second, halves up."""
    half = F.timestamp_add("MILLISECOND", F.lit(500), ts)
    return from_epoch_seconds(epoch_seconds(half))


def production_day(ts: Column, shift1_start: Column) -> Column:
    """Date an event belongs to: before the first shift starts it is still the previous day.

    ``shift1_start`` is in seconds of the day; without a schedule the calendar date is kept.
    """
    date = ts.cast("date")
    return F.when(seconds_of_day(ts) < shift1_start, F.date_sub(date, 1)).otherwise(date)


def hms(seconds: Column) -> Column:
    """Seconds as a time of day ``HH:MM:SS``; wraps at 24 hours, also for negatives."""
    s = F.pmod(seconds.cast("bigint"), F.lit(DAY))
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600),
        F.floor(s % 3600 / 60),
        s % 60,
    )
