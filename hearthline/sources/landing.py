"""Landing files: JSON lines, and server payloads flattened to channel rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hearthline.functions.casts import safe_bigint
from hearthline.schemas import CHANNELS_RAW, conform, ddl

# Channel attributes dropped before landing.
EXCLUDED_KEYS = [
    "last_message_id",
    "flags",
    "rate_limit_per_user",
    "topic",
    "position",
    "permission_overwrites",
    "nsfw",
    "bitrate",
    "user_limit",
    "rtc_region",
]

NODES = T.ArrayType(ddl("id STRING, type INT, name STRING, parent_id STRING"))
PAYLOAD = ddl("snapshot_date STRING, guild_id STRING, guild_name STRING").add("channels", NODES).add("threads", NODES)


def drop_excluded(df: DataFrame, keys: Iterable[str] = EXCLUDED_KEYS) -> DataFrame:
    return df.drop(*keys)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_payloads(spark: SparkSession, path: str, schema: T.StructType = PAYLOAD) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _nodes(payload: DataFrame, nodes: str, category: Column, parent: Column) -> DataFrame:
    rows = payload.select("snapshot_date", "guild_id", "guild_name", F.explode(nodes).alias("n"))
    return rows.filter(F.col("n.id").isNotNull()).select(
        "snapshot_date",
        F.trim("guild_id").alias("guild_id"),
        F.coalesce("guild_name", F.lit("")).alias("guild_name"),
        F.col("n.id").alias("channel_id"),
        F.coalesce("n.type", F.lit(0)).alias("channel_type"),
        F.coalesce("n.name", F.lit("")).alias("channel_name"),
        category.alias("category_id"),
        parent.alias("parent_id"),
    )


def flatten_channels(payload: DataFrame) -> DataFrame:
    """Channel rows (their parent is a category) and active threads (their parent is a channel) of every known
    guild; entries without id are skipped."""
    known = payload.filter(F.col("guild_id").isNotNull())
    above, none = safe_bigint("n.parent_id"), F.lit(None).cast("bigint")
    both = _nodes(known, "channels", above, none).unionByName(_nodes(known, "threads", none, above))
    return conform(both, CHANNELS_RAW)
