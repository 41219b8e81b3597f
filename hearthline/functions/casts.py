"""Casts that give NULL on bad input instead of failing under ANSI mode."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_bigint(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def safe_timestamp(c: str | Column) -> Column:
    """UTC wall time; text is read without any session time zone."""
    return _col(c).try_cast("timestamp_ntz")


def safe_date(c: str | Column) -> Column:
    return safe_timestamp(c).cast("date")


def ntz_lit(value: str | datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def ts_or(c: str | Column, as_of_ts: str | datetime) -> Column:
    """Parsed timestamp, or the run time where it is missing or unreadable."""
    return F.coalesce(safe_timestamp(c), ntz_lit(as_of_ts))


def or_default(c: str | Column, dtype: str, default: object) -> Column:
    return F.coalesce(_col(c).try_cast(dtype), F.lit(default).cast(dtype))


def valid_snowflake(c: str | Column) -> Column:
    """True for an id of 17 to 22 decimal digits; surrounding blanks are ignored."""
    return F.coalesce(F.trim(_col(c)).rlike("^[0-9]{17,22}$"), F.lit(False))


def name_or_unknown(c: str | Column) -> Column:
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit("unknown"))
