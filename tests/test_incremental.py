"""After any sequence of appends the incrementally refreshed tables equal a rebuild, and untouched partitions keep their files."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from hearthline.layers import Layers
from hearthline.plans import incremental, medallion
from hearthline.schemas import CHANNELS_RAW, MESSAGES_RAW, VOICE_RAW
from hearthline.sources import writers

PARTED = {"message_fact": "message_date", "voice_chat_fact": "session_date", "activity_daily": "activity_date"}


def messages(spark, rows):
    return spark.createDataFrame([(i, "7", "c", None, g, "g", u, f"u{u}", text, ts, None, 0, 0, False) for i, g, u, text, ts in rows], MESSAGES_RAW)


def sessions(spark, rows):
    return spark.createDataFrame([(s, "7", "c", None, u, f"u{u}", g, "g", a, b) for s, g, u, a, b in rows], VOICE_RAW)


def channels(spark, day, name):
    return spark.createDataFrame([(day, "1", name, "7", 0, "talk", None, None), (day, "2", "two", "8", 0, "more", None, None)], CHANNELS_RAW)


def files(root):
    return {t: {p.parent.name: p.name for p in Path(root, t).rglob("part-*")} for t in ("silver/message_fact", "silver/voice_chat_fact", "gold/activity_daily")}


def content(spark, layers, name):
    return sorted(str(r) for r in medallion.load(spark, layers, name).collect())


def equal_to_rebuild(spark, layers, run, tmp_path, step):
    whole = Layers(f"{tmp_path}/whole{step}")
    raw = Path(whole.root)
    raw.mkdir()
    (raw / "bronze").symlink_to(Path(layers.root, "bronze"))
    assert all(o[1] == "ok" for o in medallion.refresh(spark, whole, run))
    for name in medallion.STEPS:
        assert content(spark, layers, name) == content(spark, whole, name), (step, name)


def test_sequence_of_appends(spark, tmp_path):
    layers, rng = Layers(f"{tmp_path}/lake"), random.Random(6)
    writers.replace_snapshot(channels(spark, "2026-01-01", "one"), layers.name("channels_raw"))
    stamp = lambda: f"2026-01-{rng.randint(1, 9):02} {rng.randint(0, 23):02}:30:00"
    rows = lambda ids: [(str(i), rng.choice("12"), str(i % 3), f"t{rng.random()}", stamp()) for i in ids]
    incremental.record(spark, layers, "messages_raw", messages(spark, [*rows(range(20)), ("bad", "1", "1", "x", stamp()), ("90", "1", "1", "undated", "soon")]), "m0")
    incremental.record(spark, layers, "voice_activity_raw", sessions(spark, [("a", "1", "1", "2026-01-02 10:00:00", "2026-01-03 20:00:00"), ("b", "2", "1", "2026-01-05 10:00:00", None)]), "v0")
    run = medallion.Run("2026-02-01 00:00:00")
    assert incremental.refresh_changes(spark, layers, run) == {}
    equal_to_rebuild(spark, layers, run, tmp_path, 0)

    # late rows, a correction that moves a message to another day, a session that ends
    incremental.record(spark, layers, "messages_raw", messages(spark, [("3", "1", "2", "corrected", "2026-01-20 01:00:00"), ("50", "2", "1", "late", "2025-12-30 01:00:00"), ("51", "1", "1", None, None)]), "m1")
    incremental.record(spark, layers, "voice_activity_raw", sessions(spark, [("b", "2", "1", "2026-01-05 11:00:00", "2026-01-05 16:00:00")]), "v1")
    before = files(layers.root)
    run = medallion.Run("2026-02-02 00:00:00")
    touched = incremental.refresh_changes(spark, layers, run)
    equal_to_rebuild(spark, layers, run, tmp_path, 1)
    after = files(layers.root)
    for table, column in PARTED.items():
        key = next(t for t in before if t.endswith(table))
        days = {f"{column}={d}" for d in touched[table]}
        assert days and {k: v for k, v in before[key].items() if k not in days} == {k: v for k, v in after[key].items() if k not in days}
    assert len(before["silver/message_fact"].keys() - {f"message_date={d}" for d in touched["message_fact"]}) > 3

    # nothing new, same run time: only the undated rows are looked at again; then a renamed guild rewrites its days
    again = incremental.refresh_changes(spark, layers, run)
    assert [str(d) for d in again["message_fact"]] == ["2026-02-02"] and again["voice_chat_fact"] == []
    writers.replace_snapshot(channels(spark, "2026-01-02", "renamed"), layers.name("channels_raw"))
    incremental.refresh_changes(spark, layers, run)
    equal_to_rebuild(spark, layers, run, tmp_path, 2)


def test_a_lost_run_is_run_again(spark, tmp_path, monkeypatch):
    layers = Layers(f"{tmp_path}/lake")
    writers.replace_snapshot(channels(spark, "2026-01-01", "one"), layers.name("channels_raw"))
    incremental.record(spark, layers, "messages_raw", messages(spark, [("1", "1", "1", "a", "2026-01-02 10:00:00")]), "m0")
    incremental.record(spark, layers, "voice_activity_raw", sessions(spark, [("a", "1", "1", "2026-01-02 10:00:00", "2026-01-02 11:00:00")]), "v0")
    run = medallion.Run("2026-02-01 00:00:00")
    incremental.refresh_changes(spark, layers, run)
    incremental.record(spark, layers, "messages_raw", messages(spark, [("1", "1", "1", "b", "2026-01-08 10:00:00")]), "m1")
    with monkeypatch.context() as m:
        m.setattr(incremental, "_refresh_daily", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.refresh_changes(spark, layers, run)
    assert incremental.pending(spark, layers, "messages_raw").count() == 1
    incremental.refresh_changes(spark, layers, run)
    equal_to_rebuild(spark, layers, run, tmp_path, 0)
    assert incremental.pending(spark, layers, "messages_raw").count() == 0


def test_catalogs_are_refused(spark):
    with pytest.raises(ValueError):
        incremental.pending(spark, Layers(catalog="spark_catalog"), "messages_raw")
