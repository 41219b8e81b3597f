"""Nothing is lost silently: rows in are rows out, quarantined rows, or older copies of a key."""

from __future__ import annotations

from hearthline.operators import dims, facts, modelling, scd, survival

RUN = "2024-02-01 00:00:00"
MESSAGE = "message_id string, channel_id string, guild_id string, user_id string, category_id long, content string, timestamp string, attachment_count int, reaction_count int, is_pinned boolean"


def test_unreadable_ids_and_times(spark):
    row = lambda i, text, ts: (i, "1", "1", "1", None, text, ts, 0, 0, False)
    raw = spark.createDataFrame(
        [row("bad-a", "a", None), row("bad-b", "b", None), row(None, "c", None), row("7", "broken ts", "soon"), row("7", "latest good", "2024-01-02 00:00:00"), row("8", "only", "soon")],
        MESSAGE,
    )
    fact = facts.message_fact(raw, RUN, "UTC").collect()
    assert sorted((r.message_id, r.content, str(r.timestamp)) for r in fact) == [(7, "latest good", "2024-01-02 00:00:00"), (8, "only", RUN)]
    out = facts.rejected(raw, "message_id").collect()
    assert sorted((r.content, r.quarantine_reason) for r in out) == [("a", "Invalid_message_id"), ("b", "Invalid_message_id"), ("c", "Missing_message_id")]


def test_unreadable_dimension_keys(spark):
    rows = [("d1", "1", "g", "x1", 0, "one", 1), ("d1", "1", "g", "x2", 0, "two", 1), ("d1", "1", "g", "5", 0, "five", 1), ("d2", "1", "g", "5", 4, "cat", 1), ("d2", "1", "g", "x3", 4, "bad", 1)]
    raw = spark.createDataFrame(rows, "snapshot_date string, guild_id string, guild_name string, channel_id string, channel_type int, channel_name string, category_id long")
    assert [(r.channel_id, r.channel_name) for r in dims.channel_dim(raw).collect()] == [(5, "five")]
    assert [(r.category_id, r.category_name) for r in dims.category_dim(raw).collect()] == [(5, "cat")]
    assert facts.rejected(raw, "channel_id").count() == 3


def test_history_with_null_and_repeated_keys(spark):
    incoming = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    once = scd.scd2_merge(incoming, None, ["id"], "2024-01-01 00:00:00")
    twice = scd.scd2_merge(incoming, once, ["id"], "2024-01-02 00:00:00")
    assert once.count() == 1 and sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    assert [r.quarantine_reason for r in scd.keyless(incoming, ["id"]).collect()] == ["Missing_id"]
    odd = once.withColumn("is_current", once["is_current"] * None)
    assert scd.scd2_merge(incoming.limit(0), odd, ["id"], RUN).count() == 1


def test_models_score_every_row(spark):
    data = [(float(k % 7), float(k % 5), k % 2, k % 30 + 1, k % 3 % 2) for k in range(60)]
    train = spark.createDataFrame(data + [(None, 1.0, 1, 3, 1)], "x double, y double, label int, duration_days int, event_lost int")
    scored = modelling.score(modelling.fit_classifier(train, "label", ["x", "y"]), train)
    assert scored.count() == 61 and scored.filter("score IS NULL").count() == 1
    lived = survival.survival_probs(train, train, ["x", "y"])
    assert lived.count() == 61 and lived.filter("survival_prob_30d IS NULL").count() == 1 and lived.filter("NOT survival_fitted").count() == 0
