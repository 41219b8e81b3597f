"""Keep one deterministic row per key, and key-uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def row_fingerprint(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order, ties broken by the whole row's hash.

    The ``== 1`` filter lets Spark drop all but one row per key before the shuffle, so a hot key stays small.
    """
    w = W.partitionBy(*keys).orderBy(*order_by, F.col("_tie"))
    return (
        df.withColumn("_tie", row_fingerprint(df))
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "_tie")
    )


def top_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The n first rows of each group with their position; Spark limits each group before the shuffle."""
    w = W.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("record_count")).filter(F.col("record_count") > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of keys, number of repeated keys, and whether the grain holds."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("key_count"), F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).alias("duplicate_keys"))
        .withColumn("is_unique", F.col("duplicate_keys") == 0)
    )
