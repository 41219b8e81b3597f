"""Silver dimensions from their declared schemas, and the type-1 merge.

A dimension is the raw frame cast to its declared schema and reduced to one row per key. Rows whose key is missing or cannot be
read belong to no member; ``facts.rejected`` returns them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.operators.dedupe import first_per_key
from hearthline.schemas import CATEGORY_DIM, CHANNEL_DIM, GUILD_DIM, USER_DIM

CATEGORY_TYPE = 4
SNAPSHOT = "snapshot_date"


def dimension(raw: DataFrame, schema: T.StructType, source: Mapping[str, str] | None = None, latest_by: str | None = None) -> DataFrame:
    """One row per readable value of the schema's first column.

    ``source`` names raw columns that are called otherwise. Each attribute is its maximum over the member's rows, or, with
    ``latest_by``, all attributes are those of the row that is last in that column (ties: the greatest attributes).
    """
    key, attributes = schema.names[0], schema.names[1:]
    named = {f.name: F.col((source or {}).get(f.name, f.name)).try_cast(f.dataType).alias(f.name) for f in schema}
    typed = raw.select(*named.values(), *([latest_by] if latest_by else [])).filter(F.col(key).isNotNull())
    if latest_by:
        order = [F.desc(c) for c in (latest_by, *attributes)]
        return first_per_key(typed, [key], order).select(*schema.names)
    # distinct rows first: a hash aggregate, where a maximum over text alone would sort every input partition
    return typed.distinct().groupBy(key).agg(*[F.max(c).alias(c) for c in attributes])


def guild_dim(channels: DataFrame) -> DataFrame:
    return dimension(channels, GUILD_DIM)


def category_dim(channels: DataFrame) -> DataFrame:
    """Named as in the latest snapshot: a rename must not fan out later joins."""
    rows = channels.filter(F.col("channel_type") == CATEGORY_TYPE)
    return dimension(rows, CATEGORY_DIM, {"category_id": "channel_id", "category_name": "channel_name"}, latest_by=SNAPSHOT)


def channel_dim(channels: DataFrame, latest: bool = False) -> DataFrame:
    """Channels that are no categories: maximum of each attribute, or the latest snapshot's."""
    return dimension(channels.filter(F.col("channel_type") != CATEGORY_TYPE), CHANNEL_DIM, latest_by=SNAPSHOT if latest else None)


def user_dim(messages: DataFrame, voice: DataFrame | None = None) -> DataFrame:
    """Users of either table (or of the first alone)."""
    rows = messages.select(*USER_DIM.names)
    return dimension(rows if voice is None else rows.unionByName(voice.select(*USER_DIM.names)), USER_DIM)


def scd1_merge(new: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Keys are never deleted and new attributes win; without an existing table the new rows are the result. A null in a key is
    a value like any other, so a load that is repeated changes nothing."""
    if existing is None:
        return new
    both = new.withColumn("_priority", F.lit(0)).unionByName(existing.withColumn("_priority", F.lit(1)), allowMissingColumns=True)
    return first_per_key(both, keys, [F.asc("_priority")]).drop("_priority")
