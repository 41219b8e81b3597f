"""Voice-session intervals: validity, cap, duration, and exact split over hours or days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hearthline.functions.clock import (
    DEFAULT_TZ,
    epoch_seconds,
    from_epoch_seconds,
    local_date,
    local_time,
    utc_time,
)

MAX_SESSION_HOURS = 24


def valid_sessions(df: DataFrame, start: str = "joined_at", end: str = "left_at") -> DataFrame:
    return df.filter(F.col(end).isNotNull() & (F.col(end) >= F.col(start)))


def cap_sessions(df: DataFrame, max_hours: int = MAX_SESSION_HOURS, start: str = "joined_at", end: str = "left_at") -> DataFrame:
    limit = F.col(start) + F.make_dt_interval(hours=F.lit(max_hours))
    return df.withColumn(end, F.least(F.col(end), limit))


def with_duration(df: DataFrame, start: str = "joined_at", end: str = "left_at", out: str = "duration_seconds") -> DataFrame:
    return df.withColumn(out, (epoch_seconds(F.col(end)) - epoch_seconds(F.col(start))).cast("double"))


def closed_sessions(voice: DataFrame, max_hours: int = MAX_SESSION_HOURS) -> DataFrame:
    """Valid sessions of known guilds, capped: the common input of every voice aggregate. ``cut_seconds`` says what the cap
    takes away."""
    return cap_sessions(valid_sessions(voice).filter(F.col("guild_id").isNotNull()), max_hours)


def cut_seconds(voice: DataFrame, max_hours: int = MAX_SESSION_HOURS) -> DataFrame:
    """One row: how many closed sessions the cap cuts, and how many seconds of them."""
    over = with_duration(valid_sessions(voice).filter(F.col("guild_id").isNotNull())).filter(F.col("duration_seconds") > max_hours * 3600)
    return over.agg(F.count("*").alias("cut_sessions"), F.coalesce(F.sum(F.col("duration_seconds") - max_hours * 3600), F.lit(0.0)).alias("cut_seconds"))


def prorate(df: DataFrame, start: str = "joined_at", end: str = "left_at", unit: str = "hour", tz: str = DEFAULT_TZ) -> DataFrame:
    """Split each interval at local hour or day borders, seconds per piece, empty pieces dropped.

    Hours add ``bucket_local`` (local start of the hour), days add ``bucket_date``. All arithmetic is on whole
    epoch seconds; borders are taken on the local clock, so zones with offsets of half an hour or with
    23- and 25-hour days come out right. A capped interval gives at most 25 hours or 2 days.
    """
    begin, finish = epoch_seconds(F.col(start)), epoch_seconds(F.col(end))
    spans = df.withColumn("_b", begin).withColumn("_e", finish).filter(F.col("_e") > F.col("_b"))
    if unit == "hour":
        wall = local_time(F.col(start), tz)
        first = F.col("_b") - F.minute(wall) * 60 - F.second(wall)
        pieces = (
            spans.withColumn("_first", first)
            .withColumn("_last", ((F.col("_e") - 1 - F.col("_first")) / 3600).cast("int"))
            .withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_last"))))
            .withColumn("_from", F.col("_first") + F.col("_k") * 3600)
            .withColumn("_to", F.col("_from") + 3600)
            .withColumn("bucket_local", local_time(from_epoch_seconds(F.col("_from")), tz))
        )
    elif unit == "day":
        one_second = F.make_dt_interval(secs=F.lit(1))
        border = lambda day: epoch_seconds(utc_time(day.cast("timestamp_ntz"), tz))
        last_inside = local_date(from_epoch_seconds(F.col("_e")) - one_second, tz)
        pieces = (
            spans.withColumn("bucket_date", F.explode(F.sequence(local_date(F.col(start), tz), last_inside)))
            .withColumn("_from", border(F.col("bucket_date")))
            .withColumn("_to", border(F.date_add(F.col("bucket_date"), 1)))
        )
    else:
        raise ValueError(f"unit must be hour or day, not {unit!r}")
    seconds = F.least(F.col("_e"), F.col("_to")) - F.greatest(F.col("_b"), F.col("_from"))
    return (
        pieces.withColumn("duration_seconds", seconds.cast("double"))
        .filter(F.col("duration_seconds") > 0)
        .drop("_b", "_e", "_first", "_last", "_k", "_from", "_to")
    )
