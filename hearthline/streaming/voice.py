"""Voice sessions from join and leave events, as a batch plan and as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hearthline.functions.clock import instant

MEMBER = ["guild_id", "user_id"]
SLICE_DAYS = 7
KINDS = ("join", "leave")
KIND_ORDER = "CASE kind WHEN 'leave' THEN 0 ELSE 1 END"


def _event_order() -> list[Column]:
    """Events of one member in time; at the same moment a leave comes first."""
    return [F.col("ts"), F.expr(KIND_ORDER), F.col("channel_id")]


def _with_previous(events: DataFrame, value: Column) -> DataFrame:
    """``_prev``: the ``value`` of the member's previous event.

    One member may own a large share of all events, so the timeline is cut into weeks (``_week``): inside a week
    it is a plain lag, and only the first event of a week looks at the last one of the member's week before.
    Those last events, one per member and week, come out of the same windows, so the input is shuffled once.
    """
    week = W.partitionBy(*MEMBER, "_week").orderBy(*_event_order())
    inside = events.withColumn("_value", value).select(
        "*", F.lag("_value").over(week).alias("_near"), F.lead(F.lit(1)).over(week).isNull().alias("_closes")
    )
    across = inside.filter("_closes").select(
        *MEMBER, "_week", F.lag("_value").over(W.partitionBy(*MEMBER).orderBy("_week")).alias("_far")
    )
    return inside.join(across, [*MEMBER, "_week"]).select(*events.columns, F.coalesce("_near", "_far").alias("_prev"))


def _without_repeats(events: DataFrame) -> DataFrame:
    """Drop a join to the channel the member is already in."""
    seen = _with_previous(events, F.struct("kind", "channel_id", "ts"))
    repeated = (F.col("kind") == "join") & (F.col("_prev.kind") == "join") & (F.col("_prev.channel_id") == F.col("channel_id"))
    return seen.filter(~F.coalesce(repeated, F.lit(False))).drop("_prev")


def sessionize_batch(events: DataFrame, on_move: str = "drop") -> DataFrame:
    """One row per closed session. A leave ends the pending join of its member, and without one it gives a row
    whose ``joined_at`` is NULL in the channel left.

    A move to another channel overwrites the pending join (``drop``: the time before the move is lost) or
    closes it (``split``: one row per channel).
    """
    if on_move not in ("drop", "split"):
        raise ValueError("on_move is drop or split")
    week = F.floor(F.unix_date(F.col("ts").cast("date")) / SLICE_DAYS).alias("_week")
    # members and times are always known; saying so lets both uses of the shuffled events be one
    weekly = events.filter(F.col("kind").isin(*KINDS)).select(*MEMBER, "channel_id", "kind", "ts", week).dropna(subset=[*MEMBER, "_week"])
    paired = _with_previous(_without_repeats(weekly), F.struct("kind", "channel_id", "ts"))
    prev = F.col("_prev")
    pending = F.coalesce(prev["kind"] == "join", F.lit(False))
    ends = F.col("kind") == "leave"
    if on_move == "split":
        ends = ends | pending
    return paired.filter(ends).select(
        *MEMBER,
        F.when(pending, prev["channel_id"]).otherwise(F.col("channel_id")).alias("channel_id"),
        F.when(pending, prev["ts"]).alias("joined_at"),
        F.col("ts").alias("left_at"),
    )


OUTPUT = "guild_id string, user_id string, channel_id string, joined_at timestamp, left_at timestamp"
STATE = "channel_id string, joined_at timestamp"


def _advance(on_move: str, timeout_ms: int):
    def step(key: tuple[str, str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            channel, joined = state.get
            state.remove()
            yield pd.DataFrame({
                "guild_id": [key[0]], "user_id": [key[1]], "channel_id": [channel], "joined_at": [pd.Timestamp(joined)], "left_at": [pd.NaT],
            })
            return
        pending = state.get if state.exists else None
        rows = []
        events = pd.concat([b[["channel_id", "kind", "ts"]] for b in batches])
        leave_first = events["kind"].map({"leave": 0}).fillna(1)
        events = events.assign(_o=leave_first).sort_values(["ts", "_o", "channel_id"])
        for e in events.itertuples(index=False):
            if e.kind == "join":
                if pending and pending[0] == e.channel_id:
                    continue
                if pending and on_move == "split":
                    rows.append((*key, *pending, e.ts))
                pending = (e.channel_id, e.ts)
            else:
                rows.append((*key, *(pending or (e.channel_id, None)), e.ts))
                pending = None
        if pending is None:
            state.remove() if state.exists else None
        else:
            state.update(pending)
            alive = max(int(pd.Timestamp(pending[1]).timestamp() * 1000), state.getCurrentWatermarkMs())
            state.setTimeoutTimestamp(alive + timeout_ms)
        if not rows:
            return
        out = pd.DataFrame(rows, columns=["guild_id", "user_id", "channel_id", "joined_at", "left_at"])
        for c in ("joined_at", "left_at"):
            out[c] = pd.to_datetime(out[c])
        yield out

    return step


def sessionize_voice(events: DataFrame, on_move: str = "drop", timeout_hours: int = 24, delay: str = "10 minutes") -> DataFrame:
    """Streaming twin: the pending join of each member lives in the checkpointed state store and comes out as an open session
    (``left_at`` NULL) after ``timeout_hours`` of event time; a leave that comes later counts as one without join (the batch
    plan has no such limit). Events later than ``delay`` behind the watermark are dropped by the engine. Events arrive in time order between micro-batches; inside one, each
    member's events are sorted in memory, so the source's rate limit (``maxFilesPerTrigger`` and the like)
    bounds what a task holds."""
    if on_move not in ("drop", "split"):
        raise ValueError("on_move is drop or split")
    timed = events if events.schema["ts"].dataType.typeName() == "timestamp" else events.withColumn("ts", instant(F.col("ts")))
    return (
        timed.filter(F.col("kind").isin(*KINDS))
        .withWatermark("ts", delay)
        .groupBy(*MEMBER)
        .applyInPandasWithState(
            _advance(on_move, timeout_hours * 3_600_000), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
