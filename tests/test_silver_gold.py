from __future__ import annotations

from hearthline.functions.bands import hhi_status, traffic_light
from hearthline.functions.casts import name_or_unknown, safe_bigint, safe_date, safe_timestamp, valid_snowflake
from hearthline.operators import dashboards, dims, explore, facts, gold
from hearthline.operators.dedupe import first_per_key
from hearthline.operators.quality import expect, table_rules
from hearthline.schemas import CHANNELS_RAW, MESSAGES_RAW, VOICE_RAW
from pyspark.sql import functions as F

RUN = "2026-02-01 00:00:00"


def channels(spark, *rows):
    return spark.createDataFrame([(snap, "1", "g", str(ch), kind, name, cat, None) for snap, ch, kind, name, cat in rows], CHANNELS_RAW)


def message(spark, *rows):
    """(id, channel, category, user, time)"""
    return spark.createDataFrame(
        [(i, c, None, cat, "1", "g", u, f"name {u}", "hi", t, None, None, None, None) for i, c, cat, u, t in rows], MESSAGES_RAW
    )


def voice(spark, *rows):
    """(id, channel, category, user, joined, left)"""
    return spark.createDataFrame([(i, c, None, cat, u, f"name {u}", "1", "g", a, b) for i, c, cat, u, a, b in rows], VOICE_RAW)


def test_timestamp_text(spark):
    df = spark.createDataFrame([("2026-01-05 10:00:00",), ("2026-01-05 10:00:00.654",), ("junk",), (None,)], "t string")
    got = [(str(r[0]), str(r[1])) for r in df.select(safe_timestamp("t"), safe_date("t")).collect()]
    assert got == [("2026-01-05 10:00:00", "2026-01-05"), ("2026-01-05 10:00:00.654000", "2026-01-05"), ("None", "None"), ("None", "None")]


def test_safe_bigint_does_not_raise(spark):
    df = spark.createDataFrame([("17",), ("x",), ("",), (None,), ("9223372036854775808",)], "t string")
    assert [r[0] for r in df.select(safe_bigint("t")).collect()] == [17, None, None, None, None]


def test_snowflake(spark):
    df = spark.createDataFrame([("1" * 16,), ("1" * 17,), (" " + "1" * 22 + " ",), ("1" * 23,), ("1" * 16 + "a",), (None,)], "t string")
    assert [r[0] for r in df.select(valid_snowflake("t")).collect()] == [False, True, True, False, False, False]


def test_name_or_unknown(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(name_or_unknown("t")).collect()] == ["a", "unknown", "unknown"]


def test_message_fact_defaults_fallback_and_dedupe(spark):
    raw = message(spark, ("1", "10", None, "5", "junk"), ("2", "10", 7, "5", "2026-01-05 16:00:00"), ("2", "10", 8, "5", "2026-01-05 17:00:00"), (None, "10", None, "5", None))
    rows = {r.message_id: r for r in facts.message_fact(raw, RUN, "Asia/Tokyo").collect()}
    assert set(rows) == {1, 2}
    assert str(rows[1].timestamp) == RUN and str(rows[1].message_date) == "2026-02-01"
    assert (rows[1].attachment_count, rows[1].reaction_count, rows[1].is_pinned) == (0, 0, False)
    assert rows[2].category_id == 8 and str(rows[2].message_date) == "2026-01-06"  # Tokyo date of the latest copy


def test_leave_without_join_is_kept_flagged_and_not_counted(spark):
    fact = facts.voice_chat_fact(voice(spark, ("s", "10", None, "5", None, "2026-01-05 10:00:00")), RUN, "UTC")
    assert str(fact.first().joined_at) == RUN
    metrics = {r.rule: r.violations for r in expect(fact, table_rules("UTC")["voice_chat_fact"])[1].collect()}
    assert metrics == {"session_date_matches_joined_at": 0, "valid_session_duration": 1}
    guild = dims.guild_dim(channels(spark, ("2026-01-01", 10, 0, "c", None)))
    users = dims.user_dim(message(spark, ("1", "10", None, "5", RUN)), voice(spark))
    assert gold.user_voice_summary(fact, users, guild, "2026-02-01", "UTC").count() == 0


def test_date_rules_hold_in_the_zone_of_the_facts(spark):
    late = facts.message_fact(message(spark, ("1", "10", None, "5", "2026-01-05 20:00:00")), RUN, "Asia/Tokyo")
    count = lambda tz: expect(late, table_rules(tz)["message_fact"])[1].first().violations
    assert (count("Asia/Tokyo"), count("UTC")) == (0, 1)


def test_session_id_is_the_hash_of_the_text(spark):
    fact = facts.voice_chat_fact(voice(spark, ("s1", "10", None, "5", RUN, RUN)), RUN, "UTC")
    assert fact.first().session_id == spark.sql("SELECT xxhash64('s1')").first()[0]


def test_category_rename_gives_one_row(spark):
    raw = channels(spark, ("2026-01-01", 9, 4, "zzz", None), ("2026-01-02", 9, 4, "aaa", None))
    assert [tuple(r) for r in dims.category_dim(raw).collect()] == [(9, "aaa")]


def test_channel_dim_max_or_latest(spark):
    raw = channels(spark, ("2026-01-01", 10, 0, "zzz", 3), ("2026-01-02", 10, 5, "aaa", None), ("2026-01-02", 9, 4, "cat", None), ("2026-01-02", 11, None, "untyped", None))
    assert [tuple(r) for r in dims.channel_dim(raw).collect()] == [(10, 1, 5, "zzz", 3)]
    assert [tuple(r) for r in dims.channel_dim(raw, latest=True).collect()] == [(10, 1, 5, "aaa", None)]


def test_scd1_merge(spark):
    new = spark.createDataFrame([(1, "new"), (2, "b")], "k int, v string")
    old = spark.createDataFrame([(1, "old"), (3, "c")], "k int, v string")
    merged = dims.scd1_merge(new, old, ["k"])
    assert sorted(map(tuple, merged.collect())) == [(1, "new"), (2, "b"), (3, "c")]
    again = dims.scd1_merge(new, merged, ["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))
    assert dims.scd1_merge(new, None, ["k"]) is new


def test_channel_without_category_two_rows_or_one(spark):
    m = facts.message_fact(message(spark, ("1", "10", None, "5", RUN)), RUN, "UTC")
    v = facts.voice_chat_fact(voice(spark, ("s", "10", None, "5", "2026-01-05 10:00:00", "2026-01-05 11:00:00")), RUN, "UTC")
    ch = channels(spark, ("2026-01-01", 10, 0, "c", None))
    args = (m, v, dims.channel_dim(ch), dims.category_dim(ch), dims.guild_dim(ch))
    shown = lambda df: sorted((r.message_count_aggregated, r.voice_duration_seconds_aggregated) for r in df.collect())
    assert shown(gold.channel_activity(*args)) == [(0, 3600.0), (1, 0.0)]
    assert shown(gold.channel_activity(*args, null_safe=True)) == [(1, 3600.0)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS v")
    out = first_per_key(df, ["k"], [F.desc("v")])
    assert sorted(map(tuple, out.collect())) == [(0, 998), (1, 999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def summary(ntz, rows):
    return ntz(
        [(1, "g", str(i), f"u{i}", n, 7200.0, 3600.0, d, d, 1, 3.0) for i, (n, d) in enumerate(rows)],
        "guild_id bigint, guild_name string, user_id string, user_name string, session_count_aggregated bigint, voice_duration_seconds_aggregated double, "
        "avg_session_duration_seconds_aggregated double, first_voice_session_date string, last_voice_session_date string, active_week_count_aggregated bigint, tenure_weeks_aggregated double",
        dates=("first_voice_session_date", "last_voice_session_date"),
    )


def test_churn_boundaries(ntz):
    days = {7: "2026-01-25", 8: "2026-01-24", 14: "2026-01-18", 15: "2026-01-17", 30: "2026-01-02", 31: "2026-01-01"}
    df = summary(ntz, [(2, d) for d in days.values()] + [(1, "2026-01-01")])
    got = {r.days_since_last_voice: r.churn_risk_score for r in dashboards.churn_risk(df, "2026-02-01").collect()}
    assert got == {7: 10, 8: 40, 14: 40, 15: 75, 30: 75, 31: 100}


def daily(ntz, *rows):
    return ntz([(1, "g", d, 1, s) for d, s in rows], "guild_id int, guild_name string, activity_date string, message_count_aggregated bigint, voice_duration_seconds_aggregated double", dates=("activity_date",))


def test_traffic_light(ntz, spark):
    growth = spark.createDataFrame([(-15.0,), (-15.1,), (-0.1,), (0.0,), (None,)], "g double")
    assert [r[0] for r in growth.select(traffic_light(F.col("g"))).collect()] == ["YELLOW", "RED", "YELLOW", "GREEN", "GREEN"]
    both = dashboards.weekly_kpi(daily(ntz, ("2026-01-26", 900.0), ("2026-02-02", 1e9), ("2026-01-25", 500.0), ("2026-01-19", 500.0), ("2026-01-18", 1e9)), "2026-02-01").first()
    assert round(both.voice_growth_rate_pct, 6) == -10 and both.voice_health_signal == "YELLOW"
    unknown = dashboards.weekly_kpi(daily(ntz, ("2026-01-30", 5.0)), "2026-02-01").first()
    assert unknown.voice_growth_rate_pct is None and unknown.voice_health_signal == "GREEN"
    empty = dashboards.weekly_kpi(daily(ntz, ("2026-01-30", 5.0)).limit(0), "2026-02-01").first()
    assert empty.this_week_voice_hours is None and empty.voice_health_signal == "GREEN"


def test_hhi_range(ntz, spark):
    one = spark.createDataFrame([(1, "g", "c", "k", 5.0)], "guild_id int, guild_name string, channel_name string, category_name string, voice_duration_seconds_aggregated double")
    assert dashboards.channel_hhi(one).first().voice_channel_hhi == 10000
    ten = spark.range(10).selectExpr("id AS guild_id", "'g' AS guild_name", "string(id) AS channel_name", "'k' AS category_name", "3.0D AS voice_duration_seconds_aggregated")
    assert abs(dashboards.channel_hhi(ten).first().voice_channel_hhi - 1000) < 1e-9
    assert all(abs(r.voice_channel_hhi - 10000) < 1e-9 for r in dashboards.channel_hhi(ten, "guild_id").collect())


def test_hhi_bands(spark):
    df = spark.createDataFrame([(1499.9,), (1500.0,), (2499.9,), (2500.0,)], "h double")
    assert [r[0] for r in df.select(hhi_status(F.col("h"))).collect()] == ["健全（分散）", "要注意（中程度集中）", "要注意（中程度集中）", "危険（高集中）"]


def test_kpi_falls_back_to_seconds_and_clamps(ntz):
    df = ntz([("2026-01-01", "g", "c", 2, 7200.0, 0.0), ("2026-01-02", "g", None, 3, -5.0, -1.0), ("2026-02-02", "g", "c", 9, 3600.0, 1.0)],
             "activity_date string, guild_name string, category_name string, message_count bigint, voice_duration_seconds double, voice_duration_hours double", dates=("activity_date",))
    assert tuple(explore.kpi(df, "2026-01").first()) == (5, 2.0)
    assert tuple(explore.kpi(df).first()) == (14, 3.0)
    assert tuple(explore.kpi(df, categories=[""]).first()) == (3, 0.0)
    assert tuple(explore.kpi(df, "2030-01").first()) == (0, 0.0)


def test_heatmap_is_dense(spark):
    slots = spark.createDataFrame([(0, 5, 0.5), (0, 5, 0.7), (6, 23, None)], "weekday int, hour_slot int, voice_dominant_score double")
    cells = {(r.weekday, r.hour_slot): r.score for r in explore.heatmap(slots).collect()}
    assert len(cells) == 168 and cells[(0, 5)] == 0.7 and sum(cells.values()) == 0.7


def test_days_until_peak(spark):
    def days(weekday):
        slots = spark.createDataFrame([(1, "g", weekday, 3, 0.9, 2.0)], "guild_id int, guild_name string, weekday int, hour_slot int, voice_dominant_score double, voice_duration_hours double")
        return explore.peak_slot(slots, "2026-02-01").first().days_until  # a Sunday

    assert [days(w) for w in (6, 0, 5)] == [7, 1, 6]
