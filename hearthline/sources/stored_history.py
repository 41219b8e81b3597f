"""Stored type-2 history that a load rewrites in part.

Current rows stand in a table bucketed by key hash, which is also partitioned by the bucket's number, so that a directory is a
bucket: a load is shuffled to the buckets, the history is not, and only buckets with a new or changed row are written again. Closed
rows stand in a second table that only grows, one directory a load. The outcome for every key is that of ``operators.scd.scd2_merge``.

A load first writes its changes to a third table, then applies them to the other two, then drops it. Applying may be repeated, so a
load that was lost half way is finished by the next call, whatever that brings. Loads of one history are run one after another.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthline.functions.casts import ntz_lit
from hearthline.operators.dedupe import first_per_key
from hearthline.operators.scd import HISTORY, _hashed, row_hash, scd2_as_of

BUCKET, LOAD = "_bucket", "_load"


def _current(name: str) -> str:
    return f"{name}_current"


def _closed(name: str) -> str:
    return f"{name}_closed"


def _pending(name: str) -> str:
    return f"{name}_changes"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The number that both a bucketed table and ``repartition`` give to a row."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Keys and number of buckets that a history was created with."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {_current(name)}").collect()}
    return [k.strip(" `") for k in about["Bucket Columns"].strip("[]").split(",")], int(about["Num Buckets"])


def _create(rows: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    def table(df: DataFrame, part: str):
        return df.write.format("parquet").option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(part)

    table(rows.limit(0).withColumn(LOAD, F.lit("")), LOAD).saveAsTable(_closed(name))
    whole = rows.withColumn(BUCKET, _bucket(keys, buckets)).repartition(buckets, *keys)
    table(whole, BUCKET).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_current(name))


def _widen(spark: SparkSession, name: str, incoming: DataFrame) -> DataFrame:
    """The current rows after columns that the load brings anew were added to both tables."""
    current = spark.table(_current(name))
    lost = set(current.columns) - {*incoming.columns, *HISTORY, BUCKET}
    if lost:
        raise ValueError(f"the load lacks columns of the history: {sorted(lost)}")
    new = [f for f in incoming.schema.fields if f.name not in current.columns]
    for table in (_current(name), _closed(name)) if new else ():
        there = spark.table(table).columns
        add = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new if f.name not in there)
        if add:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({add})")
    return spark.table(_current(name))


def _prepared(incoming: DataFrame, current: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One row a key, in the history's types, where its bucket is."""
    load = first_per_key(incoming.dropna(subset=list(keys)), keys, [F.desc(row_hash(incoming))])
    types = {f.name: f.dataType for f in current.schema.fields}
    load = load.select(*[F.col(c).cast(types[c]).alias(c) for c in load.columns])
    return load.repartition(buckets, *keys)


def changes(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], buckets: int, as_of_ts: str | datetime, track: Sequence[str] | None = None,
    touched: Sequence[int] | None = None,
) -> DataFrame:
    """keys, bucket, the time of the load, the new row and the row it closes (null for a new key). ``touched`` names the buckets that
    the load can reach, where that is known."""
    data = [c for c in incoming.columns if c not in HISTORY]
    there = current if touched is None else current.filter(F.col(BUCKET).isin(list(touched)))
    old = _hashed(there.select(*data, *HISTORY), keys, track).select(*keys, F.col("_hash").alias("_old_hash"), F.struct(*data, "valid_from").alias("old"))
    new = _hashed(incoming.select(*data), keys, track).select(*keys, "_hash", F.struct(*data).alias("new"))
    return (
        new.join(old, list(keys), "left").filter(F.col("old").isNull() | (F.col("_hash") != F.col("_old_hash")))
        .select(*keys, _bucket(keys, buckets).alias(BUCKET), ntz_lit(as_of_ts).cast("timestamp_ntz").alias("at"), "new", "old")
    )


def _apply(spark: SparkSession, name: str) -> list[int]:
    """Brings both tables to where the pending changes lead, and drops those; returns the rewritten buckets."""
    if not spark.catalog.tableExists(_pending(name)):
        return []
    (keys, buckets), waiting = _layout(spark, name), spark.table(_pending(name))
    touched = sorted(r[0] for r in waiting.select(BUCKET).distinct().collect())
    if touched:
        current, closed = spark.table(_current(name)), spark.table(_closed(name))
        data = [c for c in current.columns if c not in {*HISTORY, BUCKET}]
        ends = {"valid_from": F.col("old.valid_from"), "valid_to": F.col("at"), "is_current": F.lit(0), LOAD: F.col(LOAD)}
        row = [ends.get(c, F.col(f"old.{c}")).alias(c) if c in ends or c in data else None for c in closed.columns]
        waiting.filter("old IS NOT NULL").select(*row).write.insertInto(_closed(name), overwrite=True)
        stays = current.filter(F.col(BUCKET).isin(touched)).select(*keys, F.struct(*[c for c in current.columns]).alias("was"))
        moved = waiting.select(*keys, "at", "new", F.col(BUCKET).alias("_to")).repartition(buckets, *keys)
        opens = {"valid_from": F.col("at"), "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(1), BUCKET: F.col("_to")}
        pick = [F.when(F.col("new").isNotNull(), opens.get(c, F.col(f"new.{c}") if c in data else None)).otherwise(F.col(f"was.{c}")).alias(c) for c in current.columns]
        stays.join(moved, keys, "full").select(*pick).write.insertInto(_current(name), overwrite=True)
    spark.sql(f"DROP TABLE {_pending(name)}")
    return touched


def merge_load(
    spark: SparkSession, name: str, incoming: DataFrame, keys: Sequence[str], as_of_ts: str | datetime,
    track: Sequence[str] | None = None, buckets: int = 256,
) -> list[int]:
    """Takes a load into the history ``name`` (a table name that gets the endings _current, _closed and _changes) and returns the
    numbers of the buckets rewritten; the first load creates the history with so many buckets, later ones keep that.

    Rows with a null key are left out, and of several rows of one key the one with the greatest hash counts. Columns that the load
    brings anew are added, null in earlier rows; a load that lacks a column of the history is refused. An empty or unchanged load
    rewrites nothing. Only bucket numbers reach the driver."""
    if not spark.catalog.tableExists(_current(name)):
        rows = first_per_key(incoming.dropna(subset=list(keys)), keys, [F.desc(row_hash(incoming))])
        opened = {"valid_from": ntz_lit(as_of_ts).cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(1)}
        _create(rows.withColumns(opened), name, keys, buckets)
        return sorted(r[0] for r in spark.table(_current(name)).select(BUCKET).distinct().collect())
    stored, buckets = _layout(spark, name)
    if stored != list(keys):
        raise ValueError(f"the history is kept by {stored}, not by {list(keys)}")
    _apply(spark, name)
    current = _widen(spark, name, incoming)
    load = _prepared(incoming, current, keys, buckets)
    touched = [r[0] for r in load.select(_bucket(keys, buckets)).distinct().collect()]
    found = changes(load, current, keys, buckets, as_of_ts, track, touched).withColumn(LOAD, F.lit(f"{as_of_ts} {uuid.uuid4().hex}"))
    found.write.format("parquet").mode("overwrite").saveAsTable(_pending(name))
    return _apply(spark, name)


def stored_current(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_current(name)).drop(BUCKET)


def stored_history(spark: SparkSession, name: str) -> DataFrame:
    """All versions, current and closed."""
    return stored_current(spark, name).unionByName(spark.table(_closed(name)).drop(LOAD))


def stored_as_of(spark: SparkSession, name: str, ts: str | datetime) -> DataFrame:
    """The rows valid at the given time."""
    return scd2_as_of(stored_history(spark, name), ts)
