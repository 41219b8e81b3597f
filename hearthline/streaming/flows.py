"""Streams into tables: bronze append, dedupe, windowed activity, expectations, snapshot replace."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions.clock import instant
from hearthline.operators.quality import Rules, holds, observe
from hearthline.sources.writers import replace_snapshot


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Make ``ts`` a TIMESTAMP, as watermarks require."""
    return df if df.schema[ts].dataType.typeName() == "timestamp" else df.withColumn(ts, instant(F.col(ts)))


def stream_to_bronze(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Exactly-once append of all waiting input: the file sink's log and the checkpoint survive restarts."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(df: DataFrame, id: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of every id; an id is remembered until the watermark passes it."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([id])


def activity_stream(df: DataFrame, every: str = "1 day", delay: str = "1 hour", ts: str = "timestamp", keys: Sequence[str] = ("guild_id",), start: str | None = None) -> DataFrame:
    """Message counts per tumbling window; rows later than the watermark are dropped. ``start`` shifts day
    borders to a local midnight (Asia/Tokyo: "15 hours")."""
    bucket = F.window(ts, every, every, start) if start else F.window(ts, every)
    counts = event_time(df, ts).withWatermark(ts, delay).groupBy(bucket, *keys).agg(F.count("*").alias("message_count"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "message_count")


def expect_stream(stream: DataFrame, rules: Rules, name: str = "expectations") -> DataFrame:
    """Rows unchanged; every micro-batch reports its violation counts to the query's listeners under ``name``."""
    counts = [F.count(F.lit(1)).alias("total_records")]
    counts += [F.coalesce(F.sum(F.when(holds(p), 0).otherwise(1)), F.lit(0)).alias(n) for n, p in rules.items()]
    return stream.observe(name, *counts)


def expect_batches(sink: Callable[[DataFrame, int], None], rules: Rules, report: Callable[[int, dict], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: write the batch with ``sink`` and report its counts from the same pass."""

    def run(batch: DataFrame, batch_id: int) -> None:
        counted, seen = observe(batch, rules, f"expectations_{batch_id}")
        sink(counted, batch_id)
        report(batch_id, seen.get)

    return run


def snapshot_stream(stream: DataFrame, path: str, checkpoint: str, key: str | Sequence[str] = "snapshot_date") -> StreamingQuery:
    """Replace the arriving snapshots' partitions; replaying a batch gives the same table."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        replace_snapshot(batch, path, key)

    return (
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
