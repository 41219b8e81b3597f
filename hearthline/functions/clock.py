"""Calendar helpers over UTC wall-time columns; every local value names its time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DEFAULT_TZ = "Asia/Tokyo"
EPOCH = "1970-01-01 00:00:00"


def local_time(ts: Column, tz: str) -> Column:
    return ts if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def utc_time(local: Column, tz: str) -> Column:
    return local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def local_date(ts: Column, tz: str) -> Column:
    return local_time(ts, tz).cast("date")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, fractions dropped."""
    return F.unix_timestamp(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit(EPOCH).cast("timestamp_ntz"))


def instant(ts: Column) -> Column:
    """The TIMESTAMP of a UTC wall time (what a watermark needs), whatever the session zone is."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts))


def week_start(day: Column) -> Column:
    """Monday of the day's week."""
    return F.date_sub(day, F.weekday(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "QUARTER")
