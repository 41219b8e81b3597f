from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hearthline.layers import Layers
from hearthline.operators import quality
from hearthline.plans import medallion
from hearthline.schemas import ACTIVITY_DAILY, CHANNELS_RAW, assert_schema
from hearthline.sources import landing, readers, versions, writers
from tests.test_silver_gold import message, voice

RUN = "2026-02-01 00:00:00"


def test_layers():
    assert Layers("/data").name("message_fact") == "/data/silver/message_fact"
    assert Layers(catalog="spark_catalog").name("user_activity") == "spark_catalog.gold.user_activity"
    with pytest.raises(ValueError):
        Layers()
    with pytest.raises(KeyError):
        Layers("/data").name("nothing")


def test_ensure_tables_keeps_existing_rows(spark, tmp_path):
    layers = Layers(str(tmp_path))
    writers.append_messages(message(spark, ("1", "10", None, "5", RUN)), layers.name("messages_raw"))
    writers.ensure_tables(spark, layers)
    assert readers.read_messages_raw(spark, layers.name("messages_raw")).count() == 1
    assert readers.read_voice_raw(spark, layers.name("voice_activity_raw")).count() == 0
    assert readers.table_exists(spark, layers.name("user_dim")) and not readers.table_exists(spark, f"{tmp_path}/absent")
    assert not readers.table_exists(spark, "absent_table")


def test_append_defaults(spark, tmp_path):
    path = f"{tmp_path}/m"
    writers.append_messages(spark.createDataFrame([("1",)], "message_id string"), path)
    row = readers.read_messages_raw(spark, path).first()
    assert (row.content, row.attachment_count, row.reaction_count, row.is_pinned, row.guild_id) == ("", 0, 0, False, None)


def test_append_voice(spark, tmp_path):
    writers.append_voice(voice(spark, ("s", "1", None, "5", RUN, None)), f"{tmp_path}/v")
    writers.append_voice(voice(spark, ("t", "1", None, "5", RUN, None)), f"{tmp_path}/v")
    assert readers.read_voice_raw(spark, f"{tmp_path}/v").count() == 2


def test_evolving_schema(spark, tmp_path):
    path = f"{tmp_path}/e"
    writers.append_evolving(spark.createDataFrame([(1,)], "a int"), path)
    writers.append_evolving(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted((r.a, r.b) for r in writers.read_evolving(spark, path).collect()) == [(1, None), (2, "x")]


def snapshot(spark, day, *names):
    return spark.createDataFrame([(day, "1", "g", str(i), 0, n, None, None) for i, n in enumerate(names)], CHANNELS_RAW)


def test_replace_snapshot_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/c"
    writers.replace_snapshot(snapshot(spark, "2026-01-01", "a", "b"), path)
    for _ in range(2):
        writers.replace_snapshot(snapshot(spark, "2026-01-02", "c"), path)
    rows = readers.read_channels_raw(spark, path)
    assert sorted((r.snapshot_date, r.channel_name) for r in rows.collect()) == [("2026-01-01", "a"), ("2026-01-01", "b"), ("2026-01-02", "c")]
    assert rows.schema["snapshot_date"].dataType.typeName() == "string"


def test_flatten_and_jsonl(spark, tmp_path):
    payload = {
        "snapshot_date": "2026-01-01", "guild_id": " 7 ", "guild_name": None,
        "channels": [{"id": "1", "type": 4, "name": "cat"}, {"id": "2", "type": 0, "name": "talk", "parent_id": "1"}, {"id": None, "name": "lost"}, {"id": "3"}],
        "threads": [{"id": "9", "type": 11, "name": "t", "parent_id": "2"}],
    }
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.json").write_text(json.dumps(payload) + "\n" + json.dumps({"guild_id": None, "channels": [{"id": "5"}]}) + "\n")
    rows = landing.flatten_channels(landing.read_payloads(spark, f"{tmp_path}/in"))
    got = sorted((r.guild_id, r.channel_id, r.channel_type, r.channel_name, r.category_id, r.parent_id) for r in rows.collect())
    assert got == [("7", "1", 4, "cat", None, None), ("7", "2", 0, "talk", 1, None), ("7", "3", 0, "", None, None), ("7", "9", 11, "t", None, 2)]
    landing.write_jsonl(landing.drop_excluded(rows.withColumn("topic", F.lit("x"))), f"{tmp_path}/out")
    assert "topic" not in spark.read.json(f"{tmp_path}/out").columns


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,\n")
    assert [tuple(r) for r in readers.read_csv_source(spark, f"{tmp_path}/a.csv", "id int, name string").collect()] == [(1, "x"), (2, None)]


def test_partitioned_write_and_schema_check(spark, tmp_path):
    df = spark.createDataFrame([(1, "g", None, 1, 1.0)], ACTIVITY_DAILY).withColumn("activity_date", F.lit("2026-01-01").cast("date"))
    writers.write_table(df, f"{tmp_path}/d", ["activity_date"], schema=ACTIVITY_DAILY)
    assert (tmp_path / "d" / "activity_date=2026-01-01").is_dir()
    with pytest.raises(ValueError):
        assert_schema(df.drop("guild_name"), ACTIVITY_DAILY)


def test_quarantine_sink(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    for run in ("2026-01-01 00:00:00", "2026-01-02 00:00:00"):
        writers.write_quarantine(df, f"{tmp_path}/q", run)
    assert spark.read.parquet(f"{tmp_path}/q").select("run_ts").distinct().count() == 2
    writers.write_quarantine(df, f"{tmp_path}/q", RUN, mode="overwrite")
    assert spark.read.parquet(f"{tmp_path}/q").count() == 1
    with pytest.raises(ValueError):
        writers.write_quarantine(df, f"{tmp_path}/q", RUN, mode="merge")


def test_quality_snapshot_rerun(spark, tmp_path):
    clean, bad = quality.split_valid(spark.range(10).toDF("v"), {"small": "v < 9"}, RUN)
    for _ in range(2):
        writers.collect_quality_snapshot(quality.quality_summary({"A": (clean, bad)}), RUN, f"{tmp_path}/ts")
    writers.collect_quality_snapshot(quality.quality_summary({"A": (clean, bad)}), "2026-02-02 00:00:00", f"{tmp_path}/ts")
    series = spark.read.parquet(f"{tmp_path}/ts")
    assert series.count() == 2 and quality.duplicate_snapshots(series).count() == 0


def test_blue_green(spark, tmp_path):
    base = f"{tmp_path}/t"
    one = versions.stage(spark.range(1), base)
    with pytest.raises(FileNotFoundError):
        versions.read_live(spark, base)
    versions.promote(spark, base, one)
    two = versions.stage(spark.range(2), base)
    assert versions.read_live(spark, base).count() == 1
    versions.promote(spark, base, two)
    assert versions.read_live(spark, base).count() == 2
    assert versions.rollback(spark, base) == one and versions.read_live(spark, base).count() == 1


def seed(spark, layers):
    writers.append_messages(message(spark, ("1", "10", None, "5", "2026-01-05 10:00:00")), layers.name("messages_raw"))
    writers.append_voice(voice(spark, ("s", "10", None, "5", "2026-01-05 14:30:00", "2026-01-05 15:30:00")), layers.name("voice_activity_raw"))
    writers.replace_snapshot(snapshot(spark, "2026-01-05", "talk"), layers.name("channels_raw"))


def test_refresh_end_to_end(spark, tmp_path):
    layers = Layers(str(tmp_path))
    seed(spark, layers)
    run = medallion.Run(RUN)
    assert [o[1:] for o in medallion.refresh(spark, layers, run)] == [("ok", None)] * len(medallion.STEPS)
    days = medallion.load(spark, layers, "activity_daily").orderBy("activity_date").collect()
    assert [(str(r.activity_date), r.message_count_aggregated, r.voice_duration_seconds_aggregated) for r in days] == [("2026-01-05", 1, 1800.0), ("2026-01-06", 0, 1800.0)]
    # a second load with renamed user keeps the key and takes the new name
    writers.append_messages(message(spark, ("2", "10", None, "6", RUN)), layers.name("messages_raw"))
    assert all(o[1] == "ok" for o in medallion.refresh(spark, layers, run))
    assert sorted(r.user_id for r in medallion.load(spark, layers, "user_dim").collect()) == [5, 6]


def test_refresh_goes_on_after_a_failure(spark, tmp_path):
    layers = Layers(str(tmp_path))
    seed(spark, layers)
    outcome = dict((n, s) for n, s, _ in medallion.refresh(spark, layers, medallion.Run(RUN), ["guild_dim", "activity_daily", "user_dim"]))
    assert outcome == {"guild_dim": "ok", "user_dim": "ok", "activity_daily": "failed"}


def test_refresh_in_a_catalog(spark):
    layers = Layers(catalog="spark_catalog")
    writers.ensure_tables(spark, layers, ["channels_raw", "guild_dim"])
    for day, guild in (("2026-01-01", "1"), ("2026-01-02", "2")):
        snapshot(spark, day, "talk").withColumn("guild_id", F.lit(guild)).select(*spark.table(layers.name("channels_raw")).columns).write.mode("overwrite").insertInto(layers.name("channels_raw"), overwrite=True)
        assert medallion.refresh(spark, layers, medallion.Run(RUN), ["guild_dim"]) == [("guild_dim", "ok", None)]
    assert sorted(r.guild_id for r in medallion.load(spark, layers, "guild_dim").collect()) == [1, 2]
    assert not readers.table_exists(spark, layers.name("guild_dim") + "_next")


def test_order_respects_inputs():
    names = medallion.order()
    assert all(names.index(i) < names.index(n) for n, s in medallion.STEPS.items() for i in s.inputs if i in names)
