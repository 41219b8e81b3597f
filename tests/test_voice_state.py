"""Out-of-order voice events between micro-batches give the batch plan's sessions, also over a restart."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hearthline.streaming.voice import sessionize_batch
from hearthline.streaming.voice_state import STORE, sessionize_voice_ordered

EVENTS = "guild_id string, user_id string, channel_id string, kind string, ts string"


@pytest.fixture
def rocks(spark):
    spark.conf.set(*STORE)
    yield spark
    spark.conf.unset(STORE[0])


def feed(spark, tmp_path, batches, on_move):
    """Each batch of rows becomes a micro-batch of its own; the query stops and restarts after each."""
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, EVENTS).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/batch={k}")
        source = spark.readStream.schema("guild_id string, user_id string, channel_id string, kind string, ts timestamp_ntz").parquet(f"{tmp_path}/in/*")
        out = sessionize_voice_ordered(source, on_move, delay="60 minutes")
        out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination(120)
    return spark.read.parquet(f"{tmp_path}/out")


def shown(df):
    return sorted(str((r.user_id, r.channel_id, r.j, r.l)) for r in df.selectExpr("*", "unix_seconds(joined_at) AS j", "unix_seconds(left_at) AS l").collect())


@pytest.mark.parametrize("on_move", ["drop", "split"])
def test_shuffled_arrival_equals_batch(rocks, tmp_path, on_move):
    rng = random.Random(9)
    rows, minute = [], 0
    for _ in range(120):
        minute += rng.randint(1, 9)
        rows.append((minute, ("g", rng.choice("uvw"), rng.choice("AB"), rng.choice(["join", "join", "leave"]))))
    stamp = lambda m: f"2026-01-05 {m // 60:02}:{m % 60:02}:00"
    arrival = sorted(rows, key=lambda r: r[0] + rng.randint(0, 50))  # less than the delay
    batches = [[(*r, stamp(m)) for m, r in arrival[k : k + 40]] for k in range(0, 120, 40)]
    batches.append([("g", "z", "A", "join", "2026-01-06 09:00:00")])  # moves the watermark past all others
    got = feed(rocks, tmp_path, batches, on_move)
    events = rocks.createDataFrame([(*r, stamp(m)) for m, r in rows], EVENTS).withColumn("ts", F.expr("to_utc_timestamp(ts, 'UTC')").cast("timestamp_ntz"))
    want = sessionize_batch(events, on_move).selectExpr("user_id", "channel_id", "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', joined_at)) AS joined_at", "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', left_at)) AS left_at")
    assert shown(got) == shown(want) and got.count() > 20


def test_open_session_and_late_leave(rocks, tmp_path):
    row = lambda u, kind, ts: ("g", u, "A", kind, ts)
    got = feed(rocks, tmp_path, [[row("u", "join", "2026-01-05 10:00:00")], [row("u", "leave", "2026-01-06 11:00:00")], [row("z", "join", "2026-01-09 10:00:00")]], "drop")
    rows = {(r.joined_at is None, r.left_at is None) for r in got.filter("user_id = 'u'").collect()}
    assert rows == {(False, True), (True, False)}
    with pytest.raises(ValueError):
        sessionize_voice_ordered(rocks.createDataFrame([], EVENTS), "other")
