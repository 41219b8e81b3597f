"""Voice sessions of a stream whose events arrive out of order, also between micro-batches.

Each member's events wait in a list state until the watermark has passed them; an event-time timer then releases all that are
final, in order, to the pairing rules of the batch plan. The pending join is a value state. So any order of arrival within ``delay``
gives the batch plan's sessions, wherever the micro-batches were cut.

The state store must be RocksDB (``STORE``), which keeps state outside the heap and lets the schema of a state grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hearthline.functions.clock import instant
from hearthline.streaming.voice import KINDS, MEMBER

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUT = "guild_id string, user_id string, channel_id string, joined_us long, left_us long"


class _Pairing(StatefulProcessor):
    """Buffers events until they are final, then pairs joins and leaves."""

    def __init__(self, on_move: str, timeout_us: int):
        self.on_move, self.timeout_us = on_move, timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, rank int, channel_id string")
        self.pending = handle.getValueState("pending", "channel_id string, us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            own = batch[["us", "rank", "channel_id"]].astype(object).where(batch[["us", "rank", "channel_id"]].notna(), None)
            self.waiting.appendList([(int(us), int(rank), channel) for us, rank, channel in own.itertuples(index=False)])
            for ms in {-(-int(us) // 1000) for us in batch["us"]}:
                self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        final = timerValues.getCurrentWatermarkInMs() * 1000
        events = list(self.waiting.get()) if self.waiting.exists() else []
        ready, later = [e for e in events if e[0] <= final], [e for e in events if e[0] > final]
        pending = tuple(self.pending.get()) if self.pending.exists() else None
        before, out = pending, []
        for us, rank, channel in sorted(ready, key=lambda e: (e[0], e[1], e[2] is not None, e[2] or "")):
            if pending and us >= pending[1] + self.timeout_us:
                out.append((*pending, None))
                pending = None
            if rank:
                if pending and pending[0] == channel:
                    continue
                if pending and self.on_move == "split":
                    out.append((*pending, us))
                pending = (channel, us)
            else:
                out.append((*(pending or (channel, None)), us))
                pending = None
        if pending and final >= pending[1] + self.timeout_us:
            out.append((*pending, None))
            pending = None
        if ready:
            self.waiting.put(later) if later else self.waiting.clear()
        if pending != before:
            self.pending.update(pending) if pending else self.pending.clear()
        if pending:
            self.handle.registerTimer(-(-(pending[1] + self.timeout_us) // 1000))
        if out:
            whole = lambda k: pd.array([x[k] for x in out], dtype="Int64")
            yield pd.DataFrame({"guild_id": key[0], "user_id": key[1], "channel_id": [x[0] for x in out], "joined_us": whole(1), "left_us": whole(2)})


def sessionize_voice_ordered(events: DataFrame, on_move: str = "drop", timeout_hours: int = 24, delay: str = "10 minutes") -> DataFrame:
    """The sessions of ``sessionize_batch`` from a stream in any order of arrival within ``delay``; later events are dropped by the
    engine. An event comes out once the watermark has passed it. A join without an end after ``timeout_hours`` of event time
    comes out as an open session (``left_at`` NULL), and a leave after that counts as one without join. Events without a member
    or time are left out, as in the batch plan.

    A member's buffer holds the events of one ``delay`` and of what the source's rate limit lets through at once.
    """
    if on_move not in ("drop", "split"):
        raise ValueError("on_move is drop or split")
    timed = events if events.schema["ts"].dataType.typeName() == "timestamp" else events.withColumn("ts", instant(F.col("ts")))
    rows = timed.filter(F.col("kind").isin(*KINDS)).dropna(subset=[*MEMBER, "ts"]).withWatermark("ts", delay).select(
        *MEMBER, "ts", F.unix_micros("ts").alias("us"), F.when(F.col("kind") == "leave", 0).otherwise(1).alias("rank"), "channel_id"
    )
    paired = rows.groupBy(*MEMBER).transformWithStateInPandas(
        _Pairing(on_move, timeout_hours * 3_600_000_000), outputStructType=OUT, outputMode="append", timeMode="eventTime"
    )
    return paired.select(*MEMBER, "channel_id", F.timestamp_micros("joined_us").alias("joined_at"), F.timestamp_micros("left_us").alias("left_at"))
