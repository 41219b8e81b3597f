"""Refresh of the day-partitioned tables from what was appended, instead of a rebuild.

``record`` appends raw rows and notes which keys they touch; ``refresh_changes`` works off the notes: of the facts it computes the
touched keys anew from all their raw copies (so late rows, corrections and moves to another day come out as in a rebuild), rewrites
the days that hold or held them, and of the daily activity the days that depend on those. All other partitions keep their files.
A batch is noted before it is appended and struck off after the last table is written; every step may be repeated, so a run that
was lost half way is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthline.functions.casts import safe_bigint, safe_timestamp
from hearthline.layers import Layers
from hearthline.plans.medallion import STEPS, Run, load, order, refresh
from hearthline.schemas import PARTITIONS
from hearthline.sources.readers import read_table, table_exists
from hearthline.sources.writers import append_messages, append_voice, replace_snapshot, write_table


@dataclass(frozen=True)
class Fact:
    """A fact, the raw table it is made of, its key in both, and the raw time on which its day rests."""

    raw: str
    raw_key: Column
    key: Column
    stamp: str


def _facts() -> dict[str, Fact]:
    text = F.col("session_id").cast("string")
    return {
        "message_fact": Fact("messages_raw", safe_bigint("message_id"), F.col("message_id"), "timestamp"),
        "voice_chat_fact": Fact("voice_activity_raw", F.xxhash64(text), F.col("session_id"), "joined_at"),
    }


DAILY = "activity_daily"


def _log(layers: Layers, *parts: str) -> str:
    if not layers.root:
        raise ValueError("changes are followed below a root directory only")
    return "/".join([layers.root, "_changes", *parts])


def record(spark: SparkSession, layers: Layers, raw: str, rows: DataFrame, batch: str) -> None:
    """Append ``rows`` to the raw table as ``batch`` (a name used once a table), noting their keys first. Other raw tables than the
    facts' are appended to by their own writers: dimensions are rebuilt in each run."""
    fact = next(f for f in _facts().values() if f.raw == raw)
    keys = rows.select(fact.raw_key.alias("key")).where("key IS NOT NULL").distinct()
    keys.write.mode("overwrite").parquet(_log(layers, "keys", raw, f"batch={batch}"))
    {"messages_raw": append_messages, "voice_activity_raw": append_voice}[raw](rows, layers.name(raw))


def pending(spark: SparkSession, layers: Layers, raw: str) -> DataFrame | None:
    """(batch, key) of the batches that no refresh has worked off; None where nothing was ever recorded."""
    return _open(spark, layers, "keys", raw, "key long")


def _open(spark: SparkSession, layers: Layers, kind: str, table: str, column: str) -> DataFrame | None:
    path = _log(layers, kind, table)
    if not table_exists(spark, path):
        return None
    noted = spark.read.schema(f"{column}, batch string").parquet(path)
    done = _log(layers, "applied", table)
    return noted.join(spark.read.schema("batch string").parquet(done), "batch", "left_anti") if table_exists(spark, done) else noted


def _strike(spark: SparkSession, layers: Layers, batches: dict[str, list[str]]) -> None:
    for table, names in batches.items():
        if names:
            spark.createDataFrame([(b,) for b in names], "batch string").coalesce(1).write.mode("append").parquet(_log(layers, "applied", table))


def _batches(noted: DataFrame | None) -> list[str]:
    return [r[0] for r in noted.select("batch").distinct().collect()] if noted is not None else []


def _note_days(spark: SparkSession, layers: Layers, name: str, days: set[date]) -> None:
    """The days of a fact that are about to change: if the run is lost after that, the next one still knows them, although a key
    that has moved no longer shows where it was."""
    if days:
        rows = spark.createDataFrame([(d,) for d in sorted(days)], "day date")
        rows.coalesce(1).write.mode("overwrite").parquet(_log(layers, "days", name, f"batch={uuid.uuid4().hex}"))


def _kept(df: DataFrame, layers: Layers) -> DataFrame:
    """The rows written beside the tables and read back: a table is overwritten only from a finished copy."""
    path = _log(layers, "work", uuid.uuid4().hex)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _days(df: DataFrame, column: str | Column) -> set[date]:
    day = F.col(column) if isinstance(column, str) else column
    return {r[0] for r in df.select(day.alias("d")).where("d IS NOT NULL").distinct().collect()}


def _among(column: str, days: Iterable[date]) -> Column:
    """A filter on the partition column that prunes directories when the plan is made."""
    return F.col(column).isin(sorted(days))


def _rewrite(layers: Layers, table: str, rows: DataFrame, days: set[date]) -> None:
    """The touched partitions become ``rows``; those left without rows go."""
    if not days:
        return
    column, path = PARTITIONS[table][0], layers.name(table)
    whole = _kept(rows, layers)
    replace_snapshot(whole.hint("rebalance", column), path, column)
    jvm, spark = rows.sparkSession._jvm, rows.sparkSession
    for day in days - _days(whole, column):
        gone = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day.isoformat()}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _refresh_fact(spark: SparkSession, layers: Layers, run: Run, name: str, fact: Fact, noted: DataFrame | None) -> set[date]:
    raw, table, day = read_table(spark, layers, fact.raw), load(spark, layers, name), PARTITIONS[name][0]
    # a row without a readable time stands at the run's time, so it moves with every run
    undated = raw.where(safe_timestamp(fact.stamp).isNull()).select(fact.raw_key.alias("key"))
    keys = undated if noted is None else undated.unionByName(noted.select("key"))
    keys = _kept(keys.where("key IS NOT NULL").distinct(), layers)
    copies = raw.withColumn("_key", fact.raw_key).join(keys.withColumnRenamed("key", "_key"), "_key", "left_semi").drop("_key")
    new = _kept(STEPS[name].build(run, copies), layers)
    keyed = table.withColumn("_key", fact.key)
    touched = keys.withColumnRenamed("key", "_key")
    days = _days(new, day) | _days(keyed.join(touched, "_key", "left_semi"), day)
    if days:
        _note_days(spark, layers, name, days)
        stay = keyed.where(_among(day, days)).join(touched, "_key", "left_anti").drop("_key")
        _rewrite(layers, name, stay.select(*table.columns).unionByName(new.select(*table.columns)), days)
    noted_days = _open(spark, layers, "days", name, "day date")
    return days if noted_days is None else days | _days(noted_days, "day")


def _refresh_daily(spark: SparkSession, layers: Layers, run: Run, message_days: set[date], voice_days: set[date]) -> set[date]:
    """A day depends on its messages and on the sessions that began on it or, capped at 24 hours, the day before."""
    one = timedelta(days=1)
    guild, daily = load(spark, layers, "guild_dim"), load(spark, layers, DAILY)
    now = guild.select("guild_id", F.col("guild_name").alias("_name"))
    renamed = daily.join(now, "guild_id", "left").where(~F.col("guild_name").eqNullSafe(F.col("_name")))
    days = message_days | voice_days | {d + one for d in voice_days} | _days(renamed, "activity_date")
    if days:
        messages = load(spark, layers, "message_fact").where(_among("message_date", days))
        voice = load(spark, layers, "voice_chat_fact").where(_among("session_date", days | {d - one for d in days}))
        rows = STEPS[DAILY].build(run, messages, voice, guild).where(_among("activity_date", days))
        _rewrite(layers, DAILY, rows.select(*daily.columns), days)
    return days


def refresh_changes(spark: SparkSession, layers: Layers, run: Run) -> dict[str, list[date]]:
    """Bring every table up to date; returns the days rewritten by table. Dimensions and the aggregates that are not
    partitioned by day are rebuilt from the refreshed facts. Without earlier tables everything is built; the days are then empty.

    Only days and batch names reach the driver. The raw tables are scanned once for the touched keys' copies, without a shuffle
    of other rows as long as the touched keys are few (AQE then joins by broadcast).
    """
    facts = _facts()
    notes = {f.raw: pending(spark, layers, f.raw) for f in facts.values()}
    batches = {raw: _batches(n) for raw, n in notes.items()}
    touched: dict[str, list[date]] = {}
    by_day = [*facts, DAILY]
    if not all(table_exists(spark, layers.name(t)) for t in by_day):
        outcome = refresh(spark, layers, run)
    else:
        dims = [n for n in STEPS if STEPS[n].merge_keys]
        outcome = refresh(spark, layers, run, dims)
        if all(state == "ok" for _, state, _ in outcome):
            days = {name: _refresh_fact(spark, layers, run, name, f, notes[f.raw]) for name, f in facts.items()}
            days[DAILY] = _refresh_daily(spark, layers, run, days["message_fact"], days["voice_chat_fact"])
            touched = {name: sorted(d) for name, d in days.items()}
            outcome += refresh(spark, layers, run, [n for n in order() if n not in {*dims, *by_day}])
    if failed := [o for o in outcome if o[1] != "ok"]:
        raise RuntimeError(f"not refreshed, the batches stay pending: {failed}")
    _strike(spark, layers, batches | {name: _batches(_open(spark, layers, "days", name, "day date")) for name in facts})
    return touched
