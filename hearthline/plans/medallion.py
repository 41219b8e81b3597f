"""Bronze to silver to gold as named steps, and their refresh in dependency order."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from hearthline.functions.clock import DEFAULT_TZ
from hearthline.layers import Layers
from hearthline.operators import dims, facts, gold
from hearthline.schemas import PARTITIONS, assert_schema
from hearthline.sources.readers import declared_schema, read_table, table_exists
from hearthline.sources.versions import latest, promote, read_live, stage
from hearthline.sources.writers import write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Run:
    """The run time and zone that replace every current date and session zone."""

    as_of_ts: str | datetime
    tz: str = DEFAULT_TZ

    @property
    def as_of(self) -> str:
        return str(self.as_of_ts)[:10]


@dataclass(frozen=True)
class Step:
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    merge_keys: tuple[str, ...] = ()


STEPS: dict[str, Step] = {
    "guild_dim": Step(("channels_raw",), lambda run, ch: dims.guild_dim(ch), ("guild_id",)),
    "category_dim": Step(("channels_raw",), lambda run, ch: dims.category_dim(ch), ("category_id",)),
    "channel_dim": Step(("channels_raw",), lambda run, ch: dims.channel_dim(ch), ("channel_id",)),
    "user_dim": Step(("messages_raw", "voice_activity_raw"), lambda run, m, v: dims.user_dim(m, v), ("user_id",)),
    "message_fact": Step(("messages_raw",), lambda run, m: facts.message_fact(m, run.as_of_ts, run.tz)),
    "voice_chat_fact": Step(("voice_activity_raw",), lambda run, v: facts.voice_chat_fact(v, run.as_of_ts, run.tz)),
    "activity_by_weekday_hour": Step(
        ("message_fact", "voice_chat_fact", "guild_dim"), lambda run, m, v, g: gold.activity_by_weekday_hour(m, v, g, run.tz)
    ),
    "activity_daily": Step(
        ("message_fact", "voice_chat_fact", "guild_dim"), lambda run, m, v, g: gold.activity_daily(m, v, g, run.tz)
    ),
    "user_activity": Step(
        ("message_fact", "voice_chat_fact", "user_dim", "guild_dim"), lambda run, m, v, u, g: gold.user_activity(m, v, u, g)
    ),
    "channel_activity": Step(
        ("message_fact", "voice_chat_fact", "channel_dim", "category_dim", "guild_dim"),
        lambda run, m, v, c, k, g: gold.channel_activity(m, v, c, k, g),
    ),
    "user_voice_summary": Step(
        ("voice_chat_fact", "user_dim", "guild_dim"), lambda run, v, u, g: gold.user_voice_summary(v, u, g, run.as_of, run.tz)
    ),
}


def order(names: Sequence[str] | None = None) -> list[str]:
    wanted = set(STEPS) if names is None else set(names)
    graph = {n: [i for i in s.inputs if i in STEPS] for n, s in STEPS.items()}
    return [n for n in TopologicalSorter(graph).static_order() if n in wanted]


def _write(spark: SparkSession, layers: Layers, name: str, df: DataFrame, merged: bool) -> None:
    schema = declared_schema(name)
    out = assert_schema(df, schema).select(*schema.names)
    target = layers.name(name)
    if layers.catalog:
        save = lambda df, table: df.write.mode("overwrite").partitionBy(*PARTITIONS.get(name, [])).saveAsTable(table)
        if merged:
            # a merged dimension reads its own previous version: the new one is complete before that is overwritten
            save(out, f"{target}_next")
            out = spark.table(f"{target}_next")
        save(out, target)
        if merged:
            spark.sql(f"DROP TABLE {target}_next")
    elif merged:
        # a merged dimension reads its own previous version, so it is built beside it and swapped in
        promote(spark, target, stage(out, target))
    else:
        write_table(out, target, PARTITIONS.get(name, []))


def load(spark: SparkSession, layers: Layers, name: str) -> DataFrame:
    step = STEPS.get(name)
    if step and step.merge_keys and layers.root:
        return read_live(spark, layers.name(name))
    return read_table(spark, layers, name)


def _previous(spark: SparkSession, layers: Layers, name: str) -> DataFrame | None:
    known = latest(spark, layers.name(name)) is not None if layers.root else table_exists(spark, layers.name(name))
    return load(spark, layers, name) if known else None


def refresh(spark: SparkSession, layers: Layers, run: Run, names: Sequence[str] | None = None) -> list[tuple[str, str, str | None]]:
    """Rebuild the named tables (all by default) after their inputs. A step that fails is logged with its
    error, the others go on, and the outcome of each is returned."""
    outcome: list[tuple[str, str, str | None]] = []
    for name in order(names):
        step = STEPS[name]
        try:
            df = step.build(run, *[load(spark, layers, i) for i in step.inputs])
            if step.merge_keys:
                df = dims.scd1_merge(df, _previous(spark, layers, name), list(step.merge_keys))
            _write(spark, layers, name, df, bool(step.merge_keys))
            outcome.append((name, "ok", None))
        except Exception as e:
            log.exception("refresh of %s failed", name)
            outcome.append((name, "failed", f"{type(e).__name__}: {e}"[:500]))
    return outcome
