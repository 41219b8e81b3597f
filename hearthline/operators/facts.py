"""Silver facts from raw rows, and the one-step transfer patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hearthline.functions.casts import or_default, safe_bigint, safe_timestamp, ts_or
from hearthline.functions.clock import DEFAULT_TZ, local_date
from hearthline.operators.dedupe import first_per_key


def _ids(*names: str) -> list[Column]:
    return [safe_bigint(n).alias(n) for n in names]


def _latest(typed: DataFrame, key: str, stamp: str, as_of_ts: str | datetime, day: str, tz: str) -> DataFrame:
    """The copy of each key with the latest readable time (unreadable ones come last), then the run time where there is none."""
    unique = first_per_key(typed.filter(F.col(key).isNotNull()), [key], [F.desc_nulls_last(stamp)])
    return unique.withColumn(stamp, ts_or(stamp, as_of_ts)).withColumn(day, local_date(F.col(stamp), tz))


def message_fact(messages: DataFrame, as_of_ts: str | datetime, tz: str = DEFAULT_TZ) -> DataFrame:
    """One row per readable message id: typed ids, defaults, and the local date of the message. Rows whose id cannot be read
    are in ``rejected``."""
    typed = messages.select(
        *_ids("message_id", "channel_id", "guild_id", "user_id", "category_id"),
        F.col("content").cast("string").alias("content"),
        safe_timestamp("timestamp").alias("timestamp"),
        or_default("attachment_count", "int", 0).alias("attachment_count"),
        or_default("reaction_count", "int", 0).alias("reaction_count"),
        or_default("is_pinned", "boolean", False).alias("is_pinned"),
    )
    return _latest(typed, "message_id", "timestamp", as_of_ts, "message_date", tz)


def voice_chat_fact(voice: DataFrame, as_of_ts: str | datetime, tz: str = DEFAULT_TZ, id: str = "xxhash64") -> DataFrame:
    """One row per session. Rows are deduplicated on the text id and hashed afterwards, so that two
    sessions whose hashes collide are not merged; ``id="raw"`` keeps the text."""
    typed = voice.select(
        F.col("session_id").cast("string").alias("session_id"),
        *_ids("channel_id", "guild_id", "user_id", "category_id"),
        safe_timestamp("joined_at").alias("joined_at"),
        safe_timestamp("left_at").alias("left_at"),
    )
    unique = _latest(typed, "session_id", "joined_at", as_of_ts, "session_date", tz)
    return unique if id == "raw" else unique.withColumn("session_id", F.xxhash64("session_id"))


def rejected(raw: DataFrame, key: str, text_id: bool = False) -> DataFrame:
    """The raw rows that a fact or dimension leaves out for its key, with ``quarantine_reason``: every row of the input is in
    the one or the other, or is an older copy of a key."""
    missing = F.col(key).isNull()
    unreadable = F.lit(False) if text_id else safe_bigint(F.col(key).cast("string")).isNull()
    reason = F.when(missing, F.lit(f"Missing_{key}")).when(unreadable, F.lit(f"Invalid_{key}"))
    return raw.withColumn("quarantine_reason", reason).filter(F.col("quarantine_reason").isNotNull())


def transfer(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    transforms: Mapping[str, Column] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Row filter, then light column transforms, then a column subset; with no arguments a pass-through."""
    out = df if where is None else df.filter(where)
    out = out.withColumns(dict(transforms)) if transforms else out
    return out if columns is None else out.select(*columns)


def transfer_all(tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, object]]) -> dict[str, DataFrame]:
    """The same for several tables at once, each by its own rule."""
    return {name: transfer(df, **rules.get(name, {})) for name, df in tables.items()}
