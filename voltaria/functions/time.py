"""Slots, seasons, local time and calendar features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """The start of the slot of ``minutes`` (a divisor of 60) that holds a timestamp, without a zone."""
    if 60 % minutes:
        raise ValueError("slots must divide the hour")
    t = F.date_trunc("minute", _name(ts))
    return (t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t) % minutes, F.lit(0))).cast("timestamp_ntz")


def floor_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", _name(ts)).cast("timestamp_ntz")


def plus(ts: Column | str, hours: int | Column = 0, minutes: int | Column = 0) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, int) else x
    return _name(ts) + F.make_dt_interval(F.lit(0), lit(hours), lit(minutes), F.lit(0))


def slot_of_day(ts: Column | str) -> Column:
    """Quarter hour of the day, 0 to 95."""
    return F.hour(_name(ts)) * 4 + F.floor(F.minute(_name(ts)) / 15).cast("int")


def is_weekday(ts: Column | str) -> Column:
    return F.weekday(_name(ts)) < 5


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Exact hours, fractions included."""
    t = lambda c: F.unix_micros(_name(c).cast("timestamp"))
    return (t(end) - t(start)) / F.lit(3_600_000_000.0)


def season_start(day: Column | str, anchor: str, months: int) -> Column:
    """First day of the season of ``months`` that holds a day, counted from the anchor month (before it, too)."""
    a = F.to_date(F.lit(anchor))
    d = _name(day)
    passed = (F.year(d) - F.year(a)) * 12 + F.month(d) - F.month(a)
    return F.add_months(F.trunc(a, "month"), (F.floor(passed / months) * months).cast("int"))


def to_instant(local: Column | str, zone: str) -> Column:
    """Naive local time -> instant."""
    return F.to_utc_timestamp(_name(local), zone)


def to_local(instant: Column | str, zone: str) -> Column:
    """Instant -> naive local time."""
    return F.from_utc_timestamp(_name(instant), zone)


def easter(year: int) -> dt.date:
    """Easter Sunday: the first Sunday after the full moon on or after 21 March (lunar tables of the Gregorian calendar)."""
    golden, century = year % 19 + 1, year // 100 + 1
    skipped, moon = 3 * century // 4 - 12, (8 * century + 5) // 25 - 5
    sunday = 5 * year // 4 - skipped - 10
    epact = (11 * golden + 20 + moon - skipped) % 30
    epact += epact == 24 or (epact == 25 and golden > 11)
    full = 44 - epact
    full += 30 * (full < 21)
    day = full + 7 - (sunday + full) % 7
    return dt.date(year, 3, 1) + dt.timedelta(days=day - 1)


#: Month and day of Italy's fixed public holidays (fixed values).
ITALIAN_HOLIDAYS = [(1, 1), (1, 6), (4, 25), (5, 1), (6, 2), (8, 15), (11, 1), (12, 8), (12, 25), (12, 26)]


def italian_holidays(spark: SparkSession, first_year: int = 2020, last_year: int = 2035) -> DataFrame:
    """(date): fixed holidays and Easter Monday of each year; a few rows per year."""
    days = [dt.date(y, m, d) for y in range(first_year, last_year + 1) for m, d in ITALIAN_HOLIDAYS]
    days += [easter(y) + dt.timedelta(days=1) for y in range(first_year, last_year + 1)]
    return spark.createDataFrame([(d,) for d in sorted(set(days))], "date date")
