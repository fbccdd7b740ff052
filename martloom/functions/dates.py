"""Date and time columns.  "Now" is never read here; callers pass it in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return F.to_date(ts)


def iso_week(ts: Column) -> Column:
    """ISO week number; the week year is ambiguous, so keep the date beside it."""
    return F.weekofyear(ts)


def period(ts: Column, fmt: str = "yyyy-MM") -> Column:
    return F.date_format(ts, fmt)


def trunc_to(ts: Column, unit: str) -> Column:
    """First day of the week, month, quarter or year that holds `ts`."""
    return F.trunc(F.to_date(ts), unit)


def int_to_date(col: Column) -> Column:
    """yyyymmdd number to date."""
    return F.to_date(col.cast("string"), "yyyyMMdd")


def date_to_int(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def age_years(birthday: Column, as_of: Column | dt.date | str) -> Column:
    """Whole years between a birthday and a given day."""
    at = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")

    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.day(d)

    before_birthday = (month_day(at) < month_day(birthday)).cast("int")
    return F.year(at) - F.year(birthday) - before_birthday


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end`; NULL while either is open."""
    return F.datediff(end, start)


def days_before(col: Column, n: Column | int) -> Column:
    return F.date_sub(col, n)


def to_ts(col: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def epoch(ts: Column) -> Column:
    """Seconds since 1970-01-01 on the column's own clock."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, ts.cast("timestamp_ntz"))


def local_time(ts: Column, zone: Column) -> Column:
    """UTC wall time shown on the clock of a time zone."""
    return F.from_utc_timestamp(ts, zone)


def on_day(ts: Column, day_value: str) -> Column:
    """Half-open range on the raw timestamp, so that the scan can skip row groups."""
    start = dt.date.fromisoformat(day_value)
    return (ts >= F.lit(start.isoformat()).cast("timestamp_ntz")) & (
        ts < F.lit((start + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    )


def trailing_days(ts: Column, day_value: str, n: int = 7) -> Column:
    """The n days that end on `day_value`, both ends included."""
    last = dt.date.fromisoformat(day_value)
    return (ts >= F.lit((last - dt.timedelta(days=n - 1)).isoformat()).cast("timestamp_ntz")) & (
        ts < F.lit((last + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    )


def active_at(start: Column, end: Column, at: Column) -> Column:
    """start <= at <= end."""
    return (start <= at) & (end >= at)
