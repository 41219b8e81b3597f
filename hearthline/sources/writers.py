"""Table writes: bootstrap, append with defaults, schema evolution, snapshot replace, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthline.functions.casts import ntz_lit, or_default
from hearthline.layers import Layers
from hearthline.schemas import LAYER_TABLES, MESSAGES_RAW, PARTITIONS, VOICE_RAW, assert_schema, conform


def ensure_tables(spark: SparkSession, layers: Layers, only: Sequence[str] | None = None) -> list[str]:
    """Create the missing tables empty, leave the others alone, and name what was looked after."""
    done = []
    for layer, tables in LAYER_TABLES.items():
        if layers.catalog:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layers.catalog}.{layer}")
        for table, schema in tables.items():
            if only is not None and table not in only:
                continue
            empty = spark.createDataFrame([], schema).write.mode("ignore").format("parquet")
            if layers.root:
                empty.save(layers.name(table))
            else:
                empty.partitionBy(*PARTITIONS.get(table, [])).saveAsTable(layers.name(table))
            done.append(table)
    return done


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", schema=None) -> None:
    """Partitioned write. Rows are first spread over the partition columns, so a task opens few files; AQE then
    splits the partitions that come out large (a hot day is written by several tasks) and joins small ones."""
    out = assert_schema(df, schema) if schema is not None else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_messages(df: DataFrame, path: str) -> None:
    """Append raw messages; absent content, counts and pin flag get their defaults."""
    rows = conform(df, MESSAGES_RAW).withColumns(
        {
            "content": F.coalesce("content", F.lit("")),
            "attachment_count": or_default("attachment_count", "int", 0),
            "reaction_count": or_default("reaction_count", "int", 0),
            "is_pinned": or_default("is_pinned", "boolean", False),
        }
    )
    rows.write.mode("append").parquet(path)


def append_voice(df: DataFrame, path: str) -> None:
    conform(df, VOICE_RAW).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may bring new nullable columns or lack old ones; read back with ``read_evolving``."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def replace_snapshot(df: DataFrame, path: str, key: str | Sequence[str] = "snapshot_date") -> None:
    """Rewrite exactly the partitions present in ``df``: a second run on the same day changes nothing else."""
    keys = [key] if isinstance(key, str) else list(key)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_quarantine(df: DataFrame, path: str, run_ts: str | datetime, mode: str = "append") -> None:
    """Append (the default) keeps earlier runs apart by ``run_ts``; overwrite keeps the last run only."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode is append or overwrite")
    df.withColumn("run_ts", ntz_lit(run_ts)).write.mode(mode).parquet(path)


def collect_quality_snapshot(summary: DataFrame, as_of_ts: str | datetime, path: str) -> None:
    """Add today's quality figures to the time series; a rerun replaces the same (date, object) rows."""
    from hearthline.operators.quality import quality_snapshot

    replace_snapshot(quality_snapshot(summary, as_of_ts), path, ["snapshot_date", "object_name"])
