from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hearthline.functions.clock import instant
from hearthline.plans.registry import Inputs
from hearthline.sources.readers import read_channels_raw
from hearthline.streaming import flows
from hearthline.streaming.voice import sessionize_batch, sessionize_voice
from tests.test_sources import snapshot

EVENTS = "guild_id string, user_id string, channel_id string, kind string, ts string"


def events(ntz, *rows):
    return ntz([("1", u, c, k, f"2026-01-05 {t}") for u, c, k, t in rows], EVENTS, ("ts",))


def shown(df):
    clock = lambda v: None if v is None else str(v)[11:16]
    return sorted(((r.user_id, r.channel_id, clock(r.joined_at), clock(r.left_at)) for r in df.collect()), key=str)


@pytest.mark.parametrize("on_move,expected", [("drop", [("u", "B", "11:00", "12:00")]), ("split", [("u", "A", "10:00", "11:00"), ("u", "B", "11:00", "12:00")])])
def test_join_move_leave(ntz, on_move, expected):
    df = events(ntz, ("u", "A", "join", "10:00"), ("u", "B", "join", "11:00"), ("u", "B", "leave", "12:00"))
    assert shown(sessionize_batch(df, on_move)) == expected


def test_same_channel_update_and_leave_without_join(ntz):
    df = events(ntz, ("u", "A", "join", "10:00"), ("u", "A", "join", "10:30"), ("u", "A", "leave", "11:00"), ("u", "A", "leave", "11:30"), ("v", "C", "leave", "09:00"))
    assert shown(sessionize_batch(df)) == [("u", "A", "10:00", "11:00"), ("u", "A", None, "11:30"), ("v", "C", None, "09:00")]


def test_pairing_across_weeks(ntz):
    rows = [("1", "u", "A", "join", "2026-01-01 10:00:00"), ("1", "u", "A", "leave", "2026-02-20 10:00:00")]
    row = sessionize_batch(ntz(rows, EVENTS, ("ts",))).first()
    assert (str(row.joined_at), str(row.left_at)) == ("2026-01-01 10:00:00", "2026-02-20 10:00:00")


def test_other_kinds_are_ignored_and_rows_stay_single(ntz):
    df = events(ntz, ("u", "A", "join", "10:00"), ("u", "A", "mute", "10:10"), ("u", "A", None, "10:20"), ("u", "A", "leave", "11:00"))
    assert shown(sessionize_batch(df)) == [("u", "A", "10:00", "11:00")]


def test_one_member_with_most_events(ntz, spark):
    rows = spark.range(4000).selectExpr(
        "'1' AS guild_id", "IF(id % 4 = 0, string(id % 50), 'hot') AS user_id", "string(id % 3) AS channel_id",
        "IF(hash(id) % 5 IN (0, 1, -1), 'leave', 'join') AS kind", "timestampadd(MINUTE, id * 37, TIMESTAMP_NTZ'2026-01-01 00:00:00') AS ts",
    )
    pending, want = {}, []
    for e in rows.orderBy("ts").collect():
        held = pending.get(e.user_id)
        if e.kind == "leave":
            want.append((e.user_id, *(held or (e.channel_id, None)), e.ts))
            pending.pop(e.user_id, None)
        elif held is None or held[0] != e.channel_id:
            pending[e.user_id] = (e.channel_id, e.ts)
    got = [(r.user_id, r.channel_id, r.joined_at, r.left_at) for r in sessionize_batch(rows).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_unknown_move_rule(ntz):
    with pytest.raises(ValueError):
        sessionize_batch(events(ntz, ("u", "A", "join", "10:00")), "keep")


def memory(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


@pytest.mark.parametrize("on_move", ["drop", "split"])
def test_stream_equals_batch(spark, tmp_path, on_move):
    batch = Inputs(spark, "/root/testdata/sf0.001").voice_events
    batch.withColumn("ts", instant(F.col("ts"))).coalesce(1).write.parquet(f"{tmp_path}/ev")
    stream = spark.readStream.schema("guild_id string, user_id string, channel_id string, kind string, ts timestamp").parquet(f"{tmp_path}/ev")
    got = memory(sessionize_voice(stream, on_move), f"sessions_{on_move}")
    utc = lambda c: F.convert_timezone(None, F.lit("UTC"), F.col(c).cast("timestamp_ntz")).alias(c)
    want = sessionize_batch(batch, on_move)
    keys = ["guild_id", "user_id", "channel_id"]
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(got.select(*keys, utc("joined_at"), utc("left_at"))) == as_text(want.select(*keys, "joined_at", "left_at"))


def test_state_spans_batches(spark, ntz, tmp_path):
    path = f"{tmp_path}/ev"
    df = events(ntz, ("u", "A", "join", "10:00"), ("u", "A", "leave", "11:00")).withColumn("ts", instant(F.col("ts")))
    schema = "guild_id string, user_id string, channel_id string, kind string, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(path)

    def run():
        out = sessionize_voice(spark.readStream.schema(schema).parquet(path))
        flows.stream_to_bronze(out, f"{tmp_path}/bronze", f"{tmp_path}/cp").awaitTermination()

    df.filter("kind = 'join'").write.mode("append").parquet(path)
    run()
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 0
    df.filter("kind = 'leave'").write.mode("append").parquet(path)
    run()
    run()  # nothing new: nothing written twice
    row = spark.read.parquet(f"{tmp_path}/bronze").collect()
    assert len(row) == 1 and (row[0].left_at - row[0].joined_at).seconds == 3600


def messages(ntz, *rows):
    return ntz([(i, "1", f"2026-01-05 {t}") for i, t in rows], "message_id string, guild_id string, timestamp string", ("timestamp",)).withColumn("timestamp", instant(F.col("timestamp")))


SCHEMA = "message_id string, guild_id string, timestamp timestamp"


def test_dedupe_stream(spark, ntz, tmp_path):
    messages(ntz, ("a", "10:00"), ("a", "10:05"), ("b", "10:00")).write.parquet(f"{tmp_path}/m")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/m")
    assert sorted(r.message_id for r in memory(flows.dedupe_stream(stream, "message_id", "timestamp"), "dedup").collect()) == ["a", "b"]


def test_activity_stream_equals_batch(spark, ntz, tmp_path):
    df = messages(ntz, ("a", "10:00"), ("b", "10:59"), ("c", "11:00"), ("z", "23:59"))
    df.coalesce(1).write.parquet(f"{tmp_path}/m")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/m")
    got = memory(flows.activity_stream(stream, "1 hour", "10 minutes"), "activity", "append")
    want = flows.activity_stream(df, "1 hour", "10 minutes")
    closed = want.filter(F.col("window_end") <= F.lit("2026-01-05 18:00:00").cast("timestamp"))  # session zone New York
    assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect())) and got.count() == 2


def test_late_rows_are_dropped(spark, ntz, tmp_path):
    path = f"{tmp_path}/m"
    messages(ntz, ("a", "20:00")).coalesce(1).write.parquet(path)
    stream = lambda: flows.activity_stream(spark.readStream.schema(SCHEMA).parquet(path), "1 hour", "10 minutes")
    run = lambda: flows.stream_to_bronze(stream(), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    run()
    messages(ntz, ("late", "10:00"), ("b", "23:30")).coalesce(1).write.mode("append").parquet(path)
    run()
    hours = [r.window_start.hour for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(hours) == 1


def test_expectations_per_batch(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/r")
    stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/r")
    reports = []
    sink = lambda df, i: df.write.mode("append").parquet(f"{tmp_path}/o")
    step = flows.expect_batches(sink, {"small": "id < 7"}, lambda i, m: reports.append(m))
    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert reports == [{"total_records": 10, "small": 3}] and spark.read.parquet(f"{tmp_path}/o").count() == 10


def test_expect_stream_reports_in_progress(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/r")
    stream = flows.expect_stream(spark.readStream.schema("id bigint").parquet(f"{tmp_path}/r"), {"small": "id < 7"})
    q = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p.observedMetrics["expectations"] for p in q.recentProgress if "expectations" in p.observedMetrics]
    assert sum(m["total_records"] for m in seen) == 10 and sum(m["small"] for m in seen) == 3


def test_snapshot_stream(spark, tmp_path):
    snapshot(spark, "2026-01-01", "a", "b").coalesce(1).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for cp in ("cp1", "cp2"):  # the second run replays all input
        flows.snapshot_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/{cp}").awaitTermination()
    assert read_channels_raw(spark, f"{tmp_path}/out").count() == 2
