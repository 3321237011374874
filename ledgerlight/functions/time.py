"""Timestamp arithmetic on columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = str | date | datetime


def as_column(value: Column | Instant | None) -> Column:
    """A timestamp column from a literal, or the column itself."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def hour_of(ts: Column | str) -> Column:
    return F.date_trunc("hour", ts)


def day_of(ts: Column | str) -> Column:
    return F.date_trunc("day", ts)


def second_of(ts: Column | str) -> Column:
    return F.date_trunc("second", ts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds with microseconds kept, as a double."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1e6)


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Difference of the two times after each is cut to its second."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def clip(ts: Column | str, lo: Column, hi: Column) -> Column:
    return F.greatest(lo, F.least(hi, _col(ts)))


def lookback(as_of: Instant, days: int) -> Column:
    """Start of the window that reaches ``days`` back from the day of ``as_of``."""
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")


def on_days_since(day: Column | str, since: Column) -> Column:
    """Rows whose day can hold times after ``since``: a hint that scans prune by.

    A day may have been cut in any time zone, so one day before counts, as does NULL.
    The exact filter on the time itself still has to follow.
    """
    return _col(day).isNull() | (_col(day) >= F.date_sub(since.cast("date"), 1))


def from_epoch_ms(ms: Column | str, keep_millis: bool = True) -> Column:
    """Epoch milliseconds to a timestamp; not positive or not a number gives NULL."""
    number = _col(ms).try_cast("bigint")
    whole = F.timestamp_millis(number) if keep_millis else F.timestamp_seconds(F.floor(number / 1000))
    return F.when(number > 0, whole)


def from_iso(text: Column | str) -> Column:
    """ISO-8601 text to a timestamp; text that does not parse gives NULL."""
    return _col(text).try_cast("timestamp")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
