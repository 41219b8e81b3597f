"""Type-2 history: change detection and the merge, as joins on the business key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hearthline.functions.casts import ntz_lit
from hearthline.operators.dedupe import first_per_key

HISTORY = ["valid_from", "valid_to", "is_current"]


def row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """SHA-256 over the row as JSON. NULL and the empty string differ, and no delimiter can collide."""
    columns = sorted(c for c in df.columns if c not in set(exclude) | set(HISTORY))
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") == 1)


def scd2_as_of(history: DataFrame, ts: str | datetime) -> DataFrame:
    """The rows valid at the given time."""
    at = ntz_lit(ts)
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in HISTORY]


def _hashed(df: DataFrame, keys: Sequence[str], track: Sequence[str] | None) -> DataFrame:
    columns = list(track) if track else [c for c in _data_columns(df) if c not in keys]
    return df.withColumn("_hash", row_hash(df.select(*columns)) if columns else F.lit(""))


def _hash_only(df: DataFrame, keys: Sequence[str], track: Sequence[str] | None) -> DataFrame:
    return _hashed(df, keys, track).select(*keys, F.col("_hash").alias("_other"))


def changed_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str], track: Sequence[str] | None = None) -> DataFrame:
    """Incoming rows whose key is current with other content (inner join, then inequality)."""
    joined = _hashed(incoming, keys, track).join(_hash_only(current, keys, track), list(keys))
    return joined.filter(F.col("_hash") != F.col("_other")).select(*incoming.columns)


def new_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.join(current.select(*keys), list(keys), "left_anti")


def unchanged_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str], track: Sequence[str] | None = None) -> DataFrame:
    """Current rows whose key arrives with the same content (left semi join on key and hash)."""
    arrivals = _hash_only(incoming, keys, track).withColumnRenamed("_other", "_hash")
    return _hashed(current, keys, track).join(arrivals, [*keys, "_hash"], "left_semi").select(*current.columns)


def missing_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    return current.join(incoming.select(*keys), list(keys), "left_anti")


def _paired(incoming: DataFrame, current: DataFrame, keys: Sequence[str], track: Sequence[str] | None, keep: bool) -> DataFrame:
    """Incoming and current side by side by key; rows travel as structs only when ``keep`` asks for them."""
    def side(df: DataFrame, name: str) -> DataFrame:
        h = _hashed(df, keys, track)
        row = F.struct(*_data_columns(df), *[c for c in HISTORY if c in df.columns]) if keep else F.lit(True)
        return h.select(*keys, F.col("_hash").alias(f"{name}_hash"), row.alias(name))

    return side(incoming, "new").join(side(current, "old"), list(keys), "full")


def scd_diff(incoming: DataFrame, current: DataFrame, keys: Sequence[str], track: Sequence[str] | None = None) -> DataFrame:
    """Counts of new, changed, unchanged and missing keys, from one full join of keys and hashes."""
    status = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "missing")
        .when(F.col("new_hash") == F.col("old_hash"), "unchanged")
        .otherwise("changed")
    )
    return _paired(incoming, current, keys, track, keep=False).groupBy(status.alias("status")).agg(F.count("*").alias("row_count"))


def keyless(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows that a merge leaves out, with ``quarantine_reason``."""
    reasons = [F.when(F.col(k).isNull(), F.lit(f"Missing_{k}")) for k in keys]
    return incoming.withColumn("quarantine_reason", F.coalesce(*reasons)).filter(F.col("quarantine_reason").isNotNull())


def scd2_merge(
    incoming: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    as_of_ts: str | datetime,
    track: Sequence[str] | None = None,
) -> DataFrame:
    """History after the load: closed rows stay, changed keys are closed and reopened, new keys open, unchanged
    and missing keys stay current. ``track`` limits change detection to some columns.

    Incoming rows with a null in a key belong to no member and are left out (``keyless`` returns them); of several rows of one
    key the one with the greatest hash counts, so a load gives the same history whenever it is repeated. Rows of the history
    whose ``is_current`` is null stay as they are.

    A single full join of the incoming and the current rows decides every case, and each pair unfolds into
    one or two output rows; history that is already closed never enters the join.
    """
    at = ntz_lit(as_of_ts)
    data = _data_columns(incoming)
    incoming = first_per_key(incoming.dropna(subset=list(keys)), keys, [F.desc(row_hash(incoming))])
    first = {"valid_from": at, "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(1)}
    if existing is None:
        return incoming.withColumns(first)
    for c in data:
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(None).cast(incoming.schema[c].dataType))
    existing = existing.select(*data, *HISTORY)
    pairs = _paired(incoming, scd2_current(existing), keys, track, keep=True)

    def version(row: str, valid_from: Column, valid_to: Column, is_current: int) -> Column:
        return F.struct(
            *[F.col(f"{row}.{c}").alias(c) for c in data],
            valid_from.cast("timestamp_ntz").alias("valid_from"),
            valid_to.cast("timestamp_ntz").alias("valid_to"),
            F.lit(is_current).alias("is_current"),
        )

    never = F.lit(None).cast("timestamp_ntz")
    opened = version("new", at, never, 1)
    kept = version("old", F.col("old.valid_from"), F.col("old.valid_to"), 1)
    closed = version("old", F.col("old.valid_from"), at, 0)
    outcome = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull() | (F.col("new_hash") == F.col("old_hash")), F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return existing.filter(~F.coalesce(F.col("is_current") == 1, F.lit(False))).unionByName(pairs.select(F.inline(outcome)))
