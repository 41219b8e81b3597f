"""Registered community queries: sources, silver, gold, dashboards, exploration, quality and history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from hearthline.functions.bands import quality_grade
from hearthline.functions.casts import or_default, safe_bigint, safe_date, safe_timestamp, ts_or, valid_snowflake
from hearthline.operators import dashboards, dims, explore, facts, filters, gold, intervals, prompts, quality, scd
from hearthline.operators.dedupe import check_unique, find_duplicates, first_per_key, top_per_group
from hearthline.operators.model_call import register_model
from hearthline.plans.fixtures import AS_OF, AS_OF_TS, TZ
from hearthline.plans.oracle import MC, VS, WEEKDAYS
from hearthline.plans.registry import Inputs, query
from hearthline.schemas import CHANNELS_RAW, MESSAGES_RAW, VOICE_RAW, conform
from hearthline.sources import stored_history
from hearthline.sources.landing import flatten_channels
from hearthline.sources.writers import union_evolving
from hearthline.streaming.voice import sessionize_batch

MEASURES = f"{MC} {VS}"

# --- sources -----------------------------------------------------------------------------------------------


@query("s1_messages_raw", """SELECT message_id, channel_id, NULL::VARCHAR AS channel_name, category_id, guild_id, NULL::VARCHAR AS guild_name, user_id,
  user_name, content, CAST(event_ts AS VARCHAR) AS "timestamp", NULL::VARCHAR AS edited_timestamp, attachment_count, reaction_count, is_pinned
  FROM fx_messages""", ints="attachment_count reaction_count")
def _(c: Inputs) -> DataFrame:
    return conform(c.messages, MESSAGES_RAW)


@query("s2_voice_raw", """SELECT session_id, channel_id, NULL::VARCHAR AS channel_name, category_id, user_id, user_name, guild_id,
  NULL::VARCHAR AS guild_name, CAST(joined_at AS VARCHAR) AS joined_at, CAST(left_at AS VARCHAR) AS left_at FROM fx_voice""")
def _(c: Inputs) -> DataFrame:
    return conform(c.voice, VOICE_RAW)


# one server payload per order: its line count gives the channels, every fourth has a thread
PAYLOAD_SQL = """SELECT '2024-01-31' AS snapshot_date, CAST(10000 + o_custkey AS VARCHAR) AS guild_id, concat('guild_', o_custkey) AS guild_name,
  concat(o_orderkey, '0', i) AS channel_id, CAST(i % 3 AS BIGINT) AS channel_type, concat('channel ', i) AS channel_name,
  CASE WHEN i % 2 = 0 THEN o_custkey END AS category_id, NULL::BIGINT AS parent_id
  FROM (SELECT *, unnest(generate_series(1, 1 + o_orderkey % 4)) AS i FROM orders)
  UNION ALL SELECT '2024-01-31', CAST(10000 + o_custkey AS VARCHAR), concat('guild_', o_custkey), concat('t', o_orderkey), 11, '', NULL, o_orderkey
  FROM orders WHERE o_orderstatus = 'F'"""


@query("s3_channels_raw", """SELECT snapshot_date, guild_id, guild_name, channel_id, channel_type, channel_name, category_id, NULL::BIGINT AS parent_id
  FROM fx_channels""", ints="channel_type")
def _(c: Inputs) -> DataFrame:
    return conform(c.channels, CHANNELS_RAW)


@query("s9_flatten_channels", PAYLOAD_SQL, ints="channel_type")
def _(c: Inputs) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    node = lambda i, t, n, p: F.struct(i.alias("id"), t.cast("int").alias("type"), n.alias("name"), p.cast("string").alias("parent_id"))
    channels = F.transform(
        F.sequence(F.lit(0).cast("bigint"), 1 + k % 4),
        lambda i: node(
            F.when(i > 0, F.concat(k.cast("string"), F.lit("0"), i.cast("string"))),
            i % 3,
            F.concat(F.lit("channel "), i.cast("string")),
            F.when(i % 2 == 0, cust),
        ),
    )
    thread = F.array(node(F.concat(F.lit("t"), k.cast("string")), F.lit(11), F.lit(None).cast("string"), k))
    payload = c.table("orders").select(
        F.lit("2024-01-31").alias("snapshot_date"),
        (10000 + cust).cast("string").alias("guild_id"),
        F.concat(F.lit("guild_"), cust.cast("string")).alias("guild_name"),
        channels.alias("channels"),
        F.when(F.col("o_orderstatus") == "F", thread).alias("threads"),
    )
    return flatten_channels(payload)


@query("s5_union_evolving", """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
  UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""", floats="balance")
def _(c: Inputs) -> DataFrame:
    old = c.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    new = c.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return union_evolving(old, new)


@query("s12_valid_snowflake", """SELECT o_orderkey, regexp_full_match(id, '[0-9]{17,22}') AS valid FROM (SELECT o_orderkey,
  concat(repeat('7', CAST(o_orderkey % 20 AS INT)), CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END, o_orderkey) AS id FROM orders)""")
def _(c: Inputs) -> DataFrame:
    k = F.col("o_orderkey")
    mark = F.when(F.col("o_orderstatus") == "P", "x").otherwise("")
    ids = F.concat(F.repeat(F.lit("7"), (k % 20).cast("int")), mark, k.cast("string"))
    return c.table("orders").select("o_orderkey", valid_snowflake(ids).alias("valid"))


@query("s15_transfer", """SELECT c_custkey, trim(lower(c_name)) AS c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
  FROM customer WHERE c_acctbal > 0""")
def _(c: Inputs) -> DataFrame:
    return facts.transfer(
        c.table("customer"),
        ["c_custkey", "c_name", "c_nationkey"],
        {"c_name": F.trim(F.lower("c_name")), "c_nationkey": F.col("c_nationkey").cast("bigint")},
        F.col("c_acctbal") > 0,
    )


@query("s15_transfer_all", """SELECT 'supplier' AS source, count(*) AS row_count FROM supplier UNION ALL SELECT 'part', count(*) FROM part WHERE p_size > 10""")
def _(c: Inputs) -> DataFrame:
    moved = facts.transfer_all({n: c.table(n) for n in ("supplier", "part")}, {"part": {"where": "p_size > 10"}})
    sizes = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("source"), "row_count") for n, df in moved.items()]
    return sizes[0].unionByName(sizes[1])


# --- casts and filters -------------------------------------------------------------------------------------

MIXED_SQL = """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(10000000000 + event_id AS VARCHAR) WHEN 1 THEN concat('id-', event_id)
  WHEN 2 THEN CAST(ts AS VARCHAR) END AS t FROM events"""


@query("f1_safe_casts", f"""SELECT event_id, TRY_CAST(t AS BIGINT) AS as_bigint, TRY_CAST(t AS TIMESTAMP) AS as_timestamp,
  CAST(TRY_CAST(t AS TIMESTAMP) AS DATE) AS as_date, coalesce(TRY_CAST(t AS TIMESTAMP), TIMESTAMP '2024-02-01 00:00:00') AS ts_or_run,
  coalesce(TRY_CAST(t AS BIGINT), 0) AS or_zero FROM ({MIXED_SQL})""")
def _(c: Inputs) -> DataFrame:
    e = F.col("event_id")
    text = (
        F.when(e % 4 == 0, (F.lit(10_000_000_000) + e).cast("string"))
        .when(e % 4 == 1, F.concat(F.lit("id-"), e.cast("string")))
        .when(e % 4 == 2, F.col("ts").cast("string"))
    )
    return c.table("events").select("event_id", text.alias("t")).select(
        "event_id",
        safe_bigint("t").alias("as_bigint"),
        safe_timestamp("t").alias("as_timestamp"),
        safe_date("t").alias("as_date"),
        ts_or("t", AS_OF_TS).alias("ts_or_run"),
        or_default("t", "bigint", 0).alias("or_zero"),
    )


@query("f11_valid_sessions", "SELECT session_id, joined_at, left_at FROM fx_voice WHERE left_at IS NOT NULL AND left_at >= joined_at")
def _(c: Inputs) -> DataFrame:
    return intervals.valid_sessions(c.voice).select("session_id", "joined_at", "left_at")


@query("f12_capped_sessions", "SELECT session_id, least(left_at, joined_at + INTERVAL 24 HOUR) AS left_at FROM fx_voice WHERE left_at >= joined_at")
def _(c: Inputs) -> DataFrame:
    return intervals.cap_sessions(intervals.valid_sessions(c.voice)).select("session_id", "left_at")


@query("f15_month_and_guild", f"SELECT * FROM gold_daily WHERE strftime(activity_date, '%Y-%m') = '2024-01' AND guild_name = 'guild_2'")
def _(c: Inputs) -> DataFrame:
    return filters.by_guild(filters.by_month(c.daily, "activity_date", "2024-01"), "guild_2")


@query("f17_categories", "SELECT * FROM gold_channel WHERE coalesce(category_name, '') IN ('', 'ASIA')")
def _(c: Inputs) -> DataFrame:
    return filters.by_categories(c.channel_activity, ["", "ASIA"])


@query("f18_exclude_categories", "SELECT * FROM gold_channel WHERE category_name IS NULL OR category_name NOT IN ('ASIA', 'EUROPE')")
def _(c: Inputs) -> DataFrame:
    return filters.exclude_categories(c.channel_activity, ["ASIA", "EUROPE"])


@query("f19_param_filter", "SELECT * FROM gold_user WHERE user_name = 'user_7'")
def _(c: Inputs) -> DataFrame:
    return filters.param_filter(filters.param_filter(c.user_activity, "guild_name", "All"), "user_name", "user_7")


# --- silver ------------------------------------------------------------------------------------------------


@query("a7_latest_per_key", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""", floats="o_totalprice")
def _(c: Inputs) -> DataFrame:
    rows = first_per_key(c.table("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query("a19_duplicates", "SELECT user_name, guild_id, count(*) AS record_count FROM fx_voice GROUP BY 1, 2 HAVING count(*) > 1")
def _(c: Inputs) -> DataFrame:
    return find_duplicates(c.voice, ["user_name", "guild_id"])


@query("b1_guild_dim", "SELECT * FROM silver_guild")
def _(c: Inputs) -> DataFrame:
    return c.guild_dim


@query("b2_category_dim", "SELECT * FROM silver_category")
def _(c: Inputs) -> DataFrame:
    return c.category_dim


@query("b3_channel_dim", "SELECT * FROM silver_channel", ints="channel_type")
def _(c: Inputs) -> DataFrame:
    return c.channel_dim


@query("b4_user_dim", "SELECT * FROM silver_user")
def _(c: Inputs) -> DataFrame:
    return c.user_dim


@query("b5_message_fact", "SELECT * FROM silver_message", ints="attachment_count reaction_count")
def _(c: Inputs) -> DataFrame:
    return c.message_fact


@query("b6_voice_chat_fact", "SELECT * FROM silver_voice")
def _(c: Inputs) -> DataFrame:
    return c.voice_fact


@query("b5_message_fact_dirty", """SELECT TRY_CAST(message_id AS BIGINT) AS message_id, user_name, content, coalesce(attachment_count, 0) AS attachment_count,
  coalesce(event_ts, TIMESTAMP '2024-02-01 00:00:00') AS "timestamp" FROM dirty_messages WHERE TRY_CAST(message_id AS BIGINT) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(message_id AS BIGINT) ORDER BY event_ts DESC NULLS LAST) = 1""".replace("user_name, ", ""), ints="attachment_count")
def _(c: Inputs) -> DataFrame:
    """Unreadable ids go to quarantine, and a copy with an unreadable time never replaces a good one."""
    return facts.message_fact(c.dirty_messages, AS_OF_TS, TZ).select("message_id", "content", "attachment_count", "timestamp")


@query("b5_rejected", """SELECT message_id, content, CASE WHEN message_id IS NULL THEN 'Missing_message_id' ELSE 'Invalid_message_id' END AS quarantine_reason
  FROM dirty_messages WHERE TRY_CAST(message_id AS BIGINT) IS NULL""")
def _(c: Inputs) -> DataFrame:
    return facts.rejected(c.dirty_messages, "message_id").select("message_id", "content", "quarantine_reason")


@query("b3_channel_dim_dirty", """SELECT TRY_CAST(channel_id AS BIGINT) AS channel_id, max(CAST(guild_id AS BIGINT)) AS guild_id, max(channel_type) AS channel_type,
  max(channel_name) AS channel_name, max(category_id) AS category_id
  FROM (SELECT * REPLACE (CASE WHEN channel_name LIKE '%7' THEN 'bad-' || channel_id ELSE channel_id END AS channel_id) FROM fx_channels)
  WHERE channel_type <> 4 AND TRY_CAST(channel_id AS BIGINT) IS NOT NULL GROUP BY 1""", ints="channel_type")
def _(c: Inputs) -> DataFrame:
    bad = F.when(F.col("channel_name").like("%7"), F.concat(F.lit("bad-"), "channel_id")).otherwise(F.col("channel_id"))
    return dims.channel_dim(c.channels.withColumn("channel_id", bad))


@query("f12_cut_seconds", """SELECT count(*) AS cut_sessions, coalesce(sum(datediff('second', joined_at, left_at) - 86400), 0) AS cut_seconds
  FROM silver_voice WHERE left_at >= joined_at AND guild_id IS NOT NULL AND datediff('second', joined_at, left_at) > 86400""", floats="cut_seconds")
def _(c: Inputs) -> DataFrame:
    return intervals.cut_seconds(c.voice_fact)


@query("b6_voice_chat_fact_hashed")
def _(c: Inputs) -> DataFrame:
    return facts.voice_chat_fact(c.voice, AS_OF_TS, TZ)


@query("b7_scd1_merge", """SELECT coalesce(n.user_id, o.user_id) AS user_id, CASE WHEN n.user_id IS NOT NULL THEN n.user_name ELSE o.user_name END AS user_name
  FROM (SELECT CAST(user_id AS BIGINT) AS user_id, max(user_name) AS user_name FROM fx_voice GROUP BY 1) n
  FULL JOIN (SELECT CAST(user_id AS BIGINT) AS user_id, concat('old_', max(user_name)) AS user_name FROM fx_messages GROUP BY 1) o
  ON n.user_id = o.user_id""")
def _(c: Inputs) -> DataFrame:
    existing = dims.user_dim(c.messages).withColumn("user_name", F.concat(F.lit("old_"), "user_name"))
    return dims.scd1_merge(dims.user_dim(c.voice), existing, ["user_id"])


# --- gold --------------------------------------------------------------------------------------------------


@query("g0a_hourly_proration", """SELECT session_id, guild_id, b AS bucket_local, secs AS duration_seconds FROM hour_pieces WHERE secs > 0""", floats="duration_seconds")
def _(c: Inputs) -> DataFrame:
    return intervals.prorate(intervals.closed_sessions(c.voice_fact), unit="hour", tz=TZ).select(
        "session_id", "guild_id", "bucket_local", "duration_seconds"
    )


@query("g0b_daily_proration", """SELECT session_id, guild_id, d AS bucket_date, secs AS duration_seconds FROM day_pieces WHERE secs > 0""", floats="duration_seconds")
def _(c: Inputs) -> DataFrame:
    return intervals.prorate(intervals.closed_sessions(c.voice_fact), unit="day", tz=TZ).select(
        "session_id", "guild_id", "bucket_date", "duration_seconds"
    )


@query("g1_activity_by_weekday_hour", "SELECT * FROM gold_wh", floats=VS, ints="weekday hour_slot")
def _(c: Inputs) -> DataFrame:
    return c.weekday_hour


@query("g2_activity_daily", "SELECT * FROM gold_daily", floats=VS)
def _(c: Inputs) -> DataFrame:
    return c.daily


@query("g3_user_activity", "SELECT * FROM gold_user", floats=VS)
def _(c: Inputs) -> DataFrame:
    return c.user_activity


@query("g4_channel_activity", "SELECT * FROM gold_channel", floats=VS)
def _(c: Inputs) -> DataFrame:
    return c.channel_activity


@query("g4_channel_activity_null_safe", "SELECT * FROM gold_channel_null_safe", floats=VS)
def _(c: Inputs) -> DataFrame:
    return gold.channel_activity(c.message_fact, c.voice_fact, c.channel_dim, c.category_dim, c.guild_dim, null_safe=True)


@query("g5_user_voice_summary", "SELECT * FROM gold_summary", floats=f"{VS} avg_session_duration_seconds_aggregated tenure_weeks_aggregated")
def _(c: Inputs) -> DataFrame:
    return c.voice_summary


# --- dashboards --------------------------------------------------------------------------------------------


@query("q1_activity_by_category_daily", "SELECT * FROM dash_category", floats="voice_duration_seconds voice_duration_hours")
def _(c: Inputs) -> DataFrame:
    return dashboards.activity_by_category_daily(c.message_fact, c.voice_fact, c.guild_dim, c.category_dim)


@query("q2_weekday_hour_display", f"SELECT *, {WEEKDAYS} AS weekday_display, {VS} / 3600.0 AS voice_duration_hours FROM gold_wh",
       floats=f"{VS} voice_duration_hours", ints="weekday hour_slot")
def _(c: Inputs) -> DataFrame:
    return dashboards.weekday_hour_display(c.weekday_hour)


@query("q3_activity_daily_hours", f"SELECT *, {VS} / 3600.0 AS voice_duration_hours FROM gold_daily", floats=f"{VS} voice_duration_hours")
def _(c: Inputs) -> DataFrame:
    return dashboards.with_voice_hours(c.daily)


@query("q4_daily_message_trend", f"SELECT activity_date, guild_name, sum({MC}) AS message_count FROM gold_daily GROUP BY 1, 2", ints="message_count")
def _(c: Inputs) -> DataFrame:
    return dashboards.daily_message_trend(c.daily)


@query("q5_daily_voice_trend", f"SELECT activity_date, guild_name, sum({VS}) / 3600.0 AS voice_hours FROM gold_daily GROUP BY 1, 2", floats="voice_hours")
def _(c: Inputs) -> DataFrame:
    return dashboards.daily_voice_trend(c.daily)


@query("q6_summary_kpis", f"SELECT sum({MC}) AS total_messages, sum({VS}) / 3600.0 AS total_voice_hours FROM gold_daily",
       floats="total_voice_hours", ints="total_messages")
def _(c: Inputs) -> DataFrame:
    return dashboards.summary_kpis(c.daily)


@query("q7_channel_table", "SELECT * FROM gold_channel", floats=VS)
def _(c: Inputs) -> DataFrame:
    return dashboards.channel_table(c.channel_activity)


@query("q8_latest_channels", """SELECT channel_id, channel_name, category_id FROM fx_channels
  WHERE snapshot_date = (SELECT max(snapshot_date) FROM fx_channels) AND channel_type IN (0, 5)""")
def _(c: Inputs) -> DataFrame:
    return dashboards.latest_channels(c.channels)


@query("q9_user_activity_hours", f"SELECT *, {VS} / 3600.0 AS voice_duration_hours FROM gold_user", floats=f"{VS} voice_duration_hours")
def _(c: Inputs) -> DataFrame:
    return dashboards.with_voice_hours(c.user_activity)


@query("q10_message_ranking", f"SELECT user_name, sum({MC}) AS message_count FROM gold_user GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25", ints="message_count")
def _(c: Inputs) -> DataFrame:
    return dashboards.message_ranking(c.user_activity)


@query("q10_message_ranking_by_id", f"SELECT user_id, user_name, sum({MC}) AS message_count FROM gold_user GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 25",
       ints="message_count")
def _(c: Inputs) -> DataFrame:
    return dashboards.message_ranking(c.user_activity, by="user_id")


@query("q11_voice_ranking", f"SELECT user_name, sum({VS}) / 3600.0 AS voice_hours FROM gold_user GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25", floats="voice_hours")
def _(c: Inputs) -> DataFrame:
    return dashboards.voice_ranking(c.user_activity)


@query("q12_active_timeslots", "SELECT * FROM dash_slots", floats=f"{VS} voice_duration_hours voice_dominant_score", ints="weekday hour_slot voice_slot_rank")
def _(c: Inputs) -> DataFrame:
    return dashboards.active_timeslots(c.weekday_hour)


HHI_SQL = """SELECT guild_id, guild_name, channel_name, category_name, voice_hours, voice_share_pct, hhi AS voice_channel_hhi,
  CASE WHEN hhi < 1500 THEN '健全（分散）' WHEN hhi < 2500 THEN '要注意（中程度集中）' ELSE '危険（高集中）' END AS hhi_status"""
HHI_FLOATS = "voice_hours voice_share_pct voice_channel_hhi"


@query("q13_channel_hhi", f"{HHI_SQL} FROM dash_hhi", floats=HHI_FLOATS)
def _(c: Inputs) -> DataFrame:
    return dashboards.channel_hhi(c.channel_activity)


@query("q13_channel_hhi_by_guild", f"""{HHI_SQL} FROM (SELECT *, voice_hours * 100 / sum(voice_hours) OVER g AS voice_share_pct,
  sum(voice_hours * voice_hours) OVER g / pow(sum(voice_hours) OVER g, 2) * 10000 AS hhi
  FROM (SELECT * EXCLUDE (voice_share_pct, hhi) FROM dash_hhi) WINDOW g AS (PARTITION BY guild_id))""", floats=HHI_FLOATS)
def _(c: Inputs) -> DataFrame:
    return dashboards.channel_hhi(c.channel_activity, partition_by="guild_id")


CHURN_SQL = f"""SELECT user_name, last_voice_session_date, days_since_last_voice, session_count_aggregated, voice_hours_total,
  CASE WHEN days_since_last_voice > 30 THEN 100 WHEN days_since_last_voice > 14 THEN 75 WHEN days_since_last_voice > 7 THEN 40 ELSE 10 END AS churn_risk_score,
  CASE WHEN days_since_last_voice > 30 THEN '離脱済み' WHEN days_since_last_voice > 14 THEN '高' WHEN days_since_last_voice > 7 THEN '要注意' ELSE '活発' END AS churn_risk_level
  FROM (SELECT *, datediff('day', last_voice_session_date, DATE '{AS_OF}') AS days_since_last_voice, {VS} / 3600.0 AS voice_hours_total
    FROM gold_summary WHERE session_count_aggregated >= 2)"""
CHURN_INTS = "days_since_last_voice churn_risk_score"


@query("q14_churn_risk", f"{CHURN_SQL} ORDER BY churn_risk_score DESC, days_since_last_voice DESC, user_id, guild_id LIMIT 30",
       floats="voice_hours_total", ints=CHURN_INTS)
def _(c: Inputs) -> DataFrame:
    return dashboards.churn_risk(c.voice_summary, AS_OF)


@query("q14_churn_risk_all", CHURN_SQL, floats="voice_hours_total", ints=CHURN_INTS)
def _(c: Inputs) -> DataFrame:
    return dashboards.churn_risk(c.voice_summary, AS_OF, n=None)


@query("q15_ltv_ranking", f"""SELECT user_name, user_id, {VS} / 3600.0 AS voice_hours_total, active_week_count_aggregated, tenure_weeks_aggregated,
  {VS} / 3600.0 * (active_week_count_aggregated / nullif(tenure_weeks_aggregated, 0)) AS voice_ltv_score FROM gold_summary
  WHERE tenure_weeks_aggregated >= 2 ORDER BY voice_ltv_score DESC NULLS LAST, user_id, guild_id LIMIT 20""",
       floats="voice_hours_total tenure_weeks_aggregated voice_ltv_score")
def _(c: Inputs) -> DataFrame:
    return dashboards.ltv_ranking(c.voice_summary)


@query("q16_session_segment", "SELECT * FROM dash_segment", floats="avg_session_minutes voice_hours_total")
def _(c: Inputs) -> DataFrame:
    return dashboards.session_segment(c.voice_summary)


@query("q17_weekday_summary", f"""SELECT weekday, {WEEKDAYS} AS weekday_label, h AS daily_voice_hours, h / nullif(max(h) OVER (), 0) AS voice_day_score,
  rank() OVER (ORDER BY h) AS low_voice_rank FROM (SELECT weekday, sum({VS}) / 3600.0 AS h FROM gold_wh GROUP BY 1)""",
       floats="daily_voice_hours voice_day_score", ints="weekday low_voice_rank")
def _(c: Inputs) -> DataFrame:
    return dashboards.weekday_summary(c.weekday_hour)


def _weeks_sql(measure: str, as_of: str) -> str:
    between = lambda a, b: f"activity_date BETWEEN DATE '{as_of}' - {a} AND DATE '{as_of}' - {b}"
    return f"""SELECT sum(CASE WHEN {between(6, 0)} THEN {measure} ELSE 0 END) AS this_week,
      sum(CASE WHEN {between(13, 7)} THEN {measure} ELSE 0 END) AS last_week FROM gold_daily"""


@query("q18_weekly_kpi", f"""SELECT *, CASE WHEN g IS NULL THEN 'GREEN' WHEN g < -15 THEN 'RED' WHEN g < 0 THEN 'YELLOW' ELSE 'GREEN' END AS voice_health_signal
  FROM (SELECT t AS this_week_voice_hours, l AS last_week_voice_hours, CASE WHEN l <> 0 THEN (t - l) / l * 100 END AS g
    FROM (SELECT this_week / 3600.0 AS t, last_week / 3600.0 AS l FROM ({_weeks_sql(VS, AS_OF)})))""".replace("SELECT *, CASE", "SELECT this_week_voice_hours, last_week_voice_hours, g AS voice_growth_rate_pct, CASE"),
       floats="this_week_voice_hours last_week_voice_hours voice_growth_rate_pct")
def _(c: Inputs) -> DataFrame:
    return dashboards.weekly_kpi(c.daily, AS_OF)


# --- exploration -------------------------------------------------------------------------------------------


@query("c1_kpi", """SELECT coalesce(sum(message_count), 0) AS messages, coalesce(sum(CASE WHEN voice_duration_hours > 0 THEN voice_duration_hours
  ELSE greatest(voice_duration_seconds, 0) / 3600.0 END), 0) AS hours FROM dash_category
  WHERE strftime(activity_date, '%Y-%m') = '2024-01' AND guild_name = 'guild_1' AND coalesce(category_name, '') IN ('ASIA', 'AMERICA', '')""",
       floats="hours", ints="messages")
def _(c: Inputs) -> DataFrame:
    rows = dashboards.activity_by_category_daily(c.message_fact, c.voice_fact, c.guild_dim, c.category_dim)
    return explore.kpi(rows, "2024-01", "guild_1", ["ASIA", "AMERICA", ""])


@query("c2_channel_ranking", f"""SELECT coalesce(nullif(channel_name, ''), 'unknown') AS name, sum({MC}) AS value FROM gold_channel
  WHERE guild_name = 'guild_1' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""", ints="value")
def _(c: Inputs) -> DataFrame:
    return explore.channel_ranking(c.channel_activity, guild="guild_1")


@query("c3_trend", f"""SELECT activity_date, guild_name, sum({MC}) AS message_count FROM gold_daily
  WHERE strftime(activity_date, '%Y-%m') = '2024-01' AND guild_name = 'guild_3' GROUP BY 1, 2""", ints="message_count")
def _(c: Inputs) -> DataFrame:
    return explore.trend(dashboards.daily_message_trend(c.daily), "2024-01", "guild_3")


@query("c4_month_options", "SELECT DISTINCT strftime(activity_date, '%Y-%m') AS option FROM gold_daily WHERE activity_date IS NOT NULL")
def _(c: Inputs) -> DataFrame:
    return explore.month_options(c.daily)


@query("c4_guild_options", "SELECT DISTINCT guild_name AS option FROM gold_channel WHERE guild_name <> ''")
def _(c: Inputs) -> DataFrame:
    return explore.guild_options(c.channel_activity)


@query("c4_category_options", "SELECT DISTINCT category_name AS option FROM gold_channel WHERE category_name <> '' AND guild_name = 'guild_2'")
def _(c: Inputs) -> DataFrame:
    return explore.category_options(c.channel_activity, "guild_2")


@query("c5_heatmap", """SELECT weekday, hour_slot, greatest(coalesce(max(voice_dominant_score), 0), 0) AS score
  FROM (SELECT w AS weekday, h AS hour_slot FROM range(7) t(w), range(24) u(h)) LEFT JOIN dash_slots USING (weekday, hour_slot) GROUP BY 1, 2""",
       floats="score", ints="weekday hour_slot")
def _(c: Inputs) -> DataFrame:
    return explore.heatmap(dashboards.active_timeslots(c.weekday_hour))


@query("c6_peak_slot", f"""SELECT s.weekday, s.hour_slot, s.voice_dominant_score AS score, s.voice_duration_hours AS voice_hours,
  (SELECT count(DISTINCT nullif(guild_name, '')) FROM dash_slots d WHERE d.weekday = s.weekday AND d.hour_slot = s.hour_slot AND d.voice_dominant_score > 0) AS guild_count,
  CASE WHEN s.weekday = isodow(DATE '{AS_OF}') - 1 THEN 7 ELSE (s.weekday - (isodow(DATE '{AS_OF}') - 1) + 7) % 7 END AS days_until
  FROM dash_slots s WHERE s.voice_dominant_score > 0 ORDER BY s.voice_dominant_score DESC, s.guild_id, s.weekday, s.hour_slot LIMIT 1""",
       floats="score voice_hours", ints="weekday hour_slot guild_count days_until")
def _(c: Inputs) -> DataFrame:
    return explore.peak_slot(dashboards.active_timeslots(c.weekday_hour), AS_OF)


@query("c7_session_quadrants", """SELECT name, user_id, x AS avg_session_minutes, y AS active_weeks, mx AS median_minutes, my AS median_weeks,
  concat(CASE WHEN x >= mx THEN 'long' ELSE 'short' END, '-', CASE WHEN y >= my THEN 'steady' ELSE 'rare' END) AS quadrant
  FROM (SELECT coalesce(nullif(user_name, ''), 'unknown') AS name, user_id, avg_session_minutes AS x, CAST(active_weeks AS DOUBLE) AS y,
    median(avg_session_minutes) OVER () AS mx, median(CAST(active_weeks AS DOUBLE)) OVER () AS my FROM dash_segment)""",
       floats="avg_session_minutes active_weeks median_minutes median_weeks")
def _(c: Inputs) -> DataFrame:
    return explore.session_quadrants(dashboards.session_segment(c.voice_summary))


@query("c8_wow_messages", f"""SELECT this_week, last_week, CASE WHEN last_week <> 0 THEN (this_week - last_week) / CAST(last_week AS DOUBLE) * 100 END AS growth_pct
  FROM ({_weeks_sql(MC, '2024-01-30')})""", floats="growth_pct", ints="this_week last_week")
def _(c: Inputs) -> DataFrame:
    return explore.wow(c.daily, MC, "2024-01-30")


@query("l4_top_rows", f"SELECT activity_date, guild_name, sum({MC}) AS message_count FROM gold_daily GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 10", ints="message_count")
def _(c: Inputs) -> DataFrame:
    return explore.top_rows(dashboards.daily_message_trend(c.daily), "activity_date", 10)


@query("l5_top_shares", "SELECT coalesce(channel_name, 'unknown') AS name, voice_share_pct AS share FROM dash_hhi ORDER BY 2 DESC, 1, guild_id LIMIT 20", floats="share")
def _(c: Inputs) -> DataFrame:
    return explore.top_shares(dashboards.channel_hhi(c.channel_activity))


# --- voice pairing -----------------------------------------------------------------------------------------

PAIR_ORDER = "PARTITION BY guild_id, user_id ORDER BY ts, CASE kind WHEN 'leave' THEN 0 ELSE 1 END, channel_id"
PAIRED_SQL = f"""SELECT *, lag(kind) OVER w AS pk, lag(channel_id) OVER w AS pc, lag(ts) OVER w AS pt FROM (
    SELECT * FROM (SELECT *, lag(kind) OVER w AS k0, lag(channel_id) OVER w AS c0 FROM fx_voice_events WINDOW w AS ({PAIR_ORDER}))
    WHERE NOT coalesce(kind = 'join' AND k0 = 'join' AND c0 = channel_id, false)) WINDOW w AS ({PAIR_ORDER})"""
PAIR_SHOWN = """SELECT guild_id, user_id, CASE WHEN pk = 'join' THEN pc ELSE channel_id END AS channel_id,
  CASE WHEN pk = 'join' THEN pt END AS joined_at, ts AS left_at"""


@query("t1_sessionize_drop", f"{PAIR_SHOWN} FROM ({PAIRED_SQL}) WHERE kind = 'leave'")
def _(c: Inputs) -> DataFrame:
    return sessionize_batch(c.voice_events, "drop")


@query("t1_sessionize_split", f"{PAIR_SHOWN} FROM ({PAIRED_SQL}) WHERE kind = 'leave' OR (kind = 'join' AND pk = 'join')")
def _(c: Inputs) -> DataFrame:
    return sessionize_batch(c.voice_events, "split")


# --- quality -----------------------------------------------------------------------------------------------

TABLE_RULES = quality.table_rules(TZ)
VOICE_RULES = {"left_known": "left_at IS NOT NULL", "in_order": "left_at >= joined_at", "has_category": "category_id IS NOT NULL"}
NAME_RULES = {"valid_id": "o_orderkey IS NOT NULL AND length(o_orderpriority) > 5", "valid_amount": "o_totalprice > 1000"}
VOICE_BAD = ["left_at IS NULL", "coalesce(left_at < joined_at, true)", "category_id IS NULL"]


@query("d1_expect", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, count(*) AS total_records, count(*) FILTER ({bad}) AS violations FROM silver_voice" for n, bad in zip(VOICE_RULES, VOICE_BAD)))
def _(c: Inputs) -> DataFrame:
    return quality.expect(c.voice_fact, VOICE_RULES)[1]


@query("d1_expect_tables", f"""SELECT 'session_date_matches_joined_at' AS rule, count(*) AS total_records, count(*) FILTER (CAST(joined_at + INTERVAL 9 HOUR AS DATE) <> session_date) AS violations FROM silver_voice
  UNION ALL SELECT 'valid_session_duration', count(*), count(*) FILTER (left_at < joined_at) FROM silver_voice
  UNION ALL SELECT 'message_date_matches_timestamp', count(*), count(*) FILTER (CAST("timestamp" + INTERVAL 9 HOUR AS DATE) <> message_date) FROM silver_message""")
def _(c: Inputs) -> DataFrame:
    voice = quality.expect(c.voice_fact, TABLE_RULES["voice_chat_fact"])[1]
    return voice.unionByName(quality.expect(c.message_fact, TABLE_RULES["message_fact"])[1])


@query("d1_expect_gold", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) AS total_records, count(*) FILTER (NOT coalesce({p}, false)) AS violations FROM {v}"
    for v, t in (("gold_wh", "activity_by_weekday_hour"), ("gold_daily", "activity_daily"), ("gold_user", "user_activity"),
                 ("gold_channel", "channel_activity"), ("gold_summary", "user_voice_summary"))
    for rule, p in TABLE_RULES[t].items()))
def _(c: Inputs) -> DataFrame:
    tables = {
        "activity_by_weekday_hour": c.weekday_hour,
        "activity_daily": c.daily,
        "user_activity": c.user_activity,
        "channel_activity": c.channel_activity,
        "user_voice_summary": c.voice_summary,
    }
    parts = [quality.expect(df, TABLE_RULES[t])[1] for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("d2_expect_or_drop", "SELECT session_id, left_at FROM silver_voice WHERE left_at >= joined_at AND category_id IS NOT NULL")
def _(c: Inputs) -> DataFrame:
    return quality.expect_or_drop(c.voice_fact, VOICE_RULES).select("session_id", "left_at")


CHECKED_SQL = """SELECT c_custkey, concat_ws(',', CASE WHEN coalesce(length(c_name) <> 18, true) THEN 'Invalid_Id' END,
  CASE WHEN coalesce(length(trim(c_mktsegment)) < 9, true) THEN 'Invalid_Name' END) AS reasons FROM customer"""


@query("d5_validate_columns", f"SELECT c_custkey, reasons FROM ({CHECKED_SQL}) WHERE reasons <> ''")
def _(c: Inputs) -> DataFrame:
    df = quality.add_quarantine_columns(c.table("customer"), AS_OF_TS)
    df = quality.validate_id_column(df, "c_name", "Invalid_Id")
    df = quality.validate_name_column(df, "c_mktsegment", 9, "Invalid_Name")
    return quality.filter_invalid_records(df).select("c_custkey", F.array_join("quarantine_reason", ",").alias("reasons"))


def _split(c: Inputs) -> tuple[DataFrame, DataFrame]:
    return quality.split_valid(c.table("orders"), NAME_RULES, AS_OF_TS)


def _split_voice(c: Inputs) -> tuple[DataFrame, DataFrame]:
    return quality.split_valid(c.voice_fact, VOICE_RULES, AS_OF_TS)


ORDER_BAD = "(o_orderkey IS NULL OR length(o_orderpriority) <= 5 OR o_totalprice <= 1000)"
VOICE_ANY = "(left_at IS NULL OR left_at < joined_at OR category_id IS NULL)"


@query("d7_split_valid", f"""SELECT o_orderkey, CASE WHEN {ORDER_BAD} THEN 'quarantine' ELSE 'valid' END AS side FROM orders""")
def _(c: Inputs) -> DataFrame:
    good, bad = _split(c)
    side = lambda df, s: df.select("o_orderkey", F.lit(s).alias("side"))
    return side(good, "valid").unionByName(side(bad, "quarantine"))


SUMMARY_SQL = f"""SELECT *, CASE WHEN total_records = 0 THEN 0 ELSE passed_records * 100.0 / total_records END AS pass_rate,
  CASE WHEN total_records = 0 THEN 0 ELSE quarantine_records * 100.0 / total_records END AS quarantine_rate FROM (
  SELECT 'Order' AS object_name, 'orders' AS table_name, count(*) AS total_records, count(*) FILTER (NOT {ORDER_BAD}) AS passed_records,
    count(*) FILTER ({ORDER_BAD}) AS quarantine_records FROM orders
  UNION ALL SELECT 'Voice', 'voice_chat_fact', count(*), count(*) FILTER (NOT coalesce({VOICE_ANY}, false)), count(*) FILTER ({VOICE_ANY}) FROM silver_voice
  UNION ALL SELECT 'Part', 'Part', count(*), count(*), 0 FROM part)"""


def _summary(c: Inputs) -> DataFrame:
    tables = {"Order": _split(c), "Voice": _split_voice(c), "Part": (c.table("part"), None)}
    return quality.quality_summary(tables, {"Order": "orders", "Voice": "voice_chat_fact"})


@query("d8_quality_summary", SUMMARY_SQL, floats="pass_rate quarantine_rate", digits=2)
def _(c: Inputs) -> DataFrame:
    return _summary(c)


@query("d9_reason_summary", " UNION ALL ".join(
    f"SELECT 'Voice' AS object_name, '{n}' AS reason, count(*) AS record_count FROM silver_voice WHERE {bad} HAVING count(*) > 0" for n, bad in zip(VOICE_RULES, VOICE_BAD)))
def _(c: Inputs) -> DataFrame:
    return quality.reason_summary(quality.common_quarantine({"Voice": (_split_voice(c)[1], "session_id")}))


REASONS_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {bad} THEN '{n}' END" for n, bad in zip(VOICE_RULES, VOICE_BAD)) + ")"


@query("d10_quarantine_samples", f"""SELECT 'Voice' AS object_name, session_id AS record_id, {REASONS_SQL} AS reasons, TIMESTAMP '{AS_OF_TS}' AS quarantine_ts
  FROM silver_voice WHERE {VOICE_ANY} ORDER BY session_id LIMIT 10""")
def _(c: Inputs) -> DataFrame:
    return quality.quarantine_samples({"Voice": (_split_voice(c)[1], "session_id")}, 10)


@query("d10_quarantine_details", " UNION ALL ".join(
    f"SELECT session_id AS record_id, '{n}' AS reason, '{t}' AS target_column, joined_at FROM silver_voice WHERE {bad}"
    for n, t, bad in zip(VOICE_RULES, ("left_at", "left_at", "category_id"), VOICE_BAD)))
def _(c: Inputs) -> DataFrame:
    q = quality.common_quarantine({"Voice": (_split_voice(c)[1], "session_id")})
    targets = {"left_known": "left_at", "in_order": "left_at", "has_category": "category_id"}
    return quality.quarantine_details(q, c.voice_fact, "session_id", targets).select("record_id", "reason", "target_column", "joined_at")


@query("d11_over_threshold", f"SELECT * FROM ({SUMMARY_SQL}) WHERE quarantine_rate > 5", floats="pass_rate quarantine_rate", digits=2)
def _(c: Inputs) -> DataFrame:
    return quality.over_threshold(_summary(c), 5.0)


# a quality series by day, from the sessions of each day
SERIES_SQL = f"""SELECT *, CAST(passed_records * 100.0 / total_records AS DECIMAL(5,2)) AS pass_rate,
  CAST(quarantine_records * 100.0 / total_records AS DECIMAL(5,2)) AS quarantine_rate FROM (SELECT concat('guild ', guild_id) AS object_name,
  CAST(session_date AS TIMESTAMP) AS snapshot_timestamp, session_date AS snapshot_date, count(*) AS total_records,
  count(*) FILTER (NOT coalesce({VOICE_ANY}, false)) AS passed_records, count(*) FILTER ({VOICE_ANY}) AS quarantine_records FROM silver_voice GROUP BY 1, 2, 3)"""


def _series(c: Inputs) -> DataFrame:
    bad = ~quality.holds("left_at IS NOT NULL AND left_at >= joined_at AND category_id IS NOT NULL")
    daily = c.voice_fact.groupBy(
        F.concat(F.lit("guild "), F.col("guild_id").cast("string")).alias("object_name"),
        F.col("session_date").cast("timestamp_ntz").alias("snapshot_timestamp"),
        F.col("session_date").alias("snapshot_date"),
    ).agg(F.count("*").alias("total_records"), F.count_if(~bad).alias("passed_records"), F.count_if(bad).alias("quarantine_records"))
    rate = lambda n: (F.col(n) * 100.0 / F.col("total_records")).cast("decimal(5,2)")
    return daily.withColumns({"pass_rate": rate("passed_records"), "quarantine_rate": rate("quarantine_records")})


@query("d13_quality_trend", f"""SELECT object_name, snapshot_timestamp, pass_rate, lag(pass_rate) OVER w AS previous_pass_rate, pass_rate - lag(pass_rate) OVER w AS pass_rate_change,
  CASE WHEN pass_rate >= 95 THEN '優秀' WHEN pass_rate >= 90 THEN '良好' WHEN pass_rate >= 80 THEN '普通' WHEN pass_rate >= 70 THEN '要改善' ELSE '要緊急対応' END AS grade
  FROM ({SERIES_SQL}) WINDOW w AS (PARTITION BY object_name ORDER BY snapshot_timestamp)""",
       floats="pass_rate previous_pass_rate pass_rate_change", digits=2)
def _(c: Inputs) -> DataFrame:
    return quality.quality_trend(_series(c))


@query("d13_quality_overall", f"""SELECT snapshot_date, t AS total_records, p AS passed_records, q AS quarantine_records, CAST(p * 100.0 / t AS DECIMAL(5,2)) AS pass_rate,
  CAST(q * 100.0 / t AS DECIMAL(5,2)) AS quarantine_rate FROM (SELECT snapshot_date, sum(total_records) AS t, sum(passed_records) AS p, sum(quarantine_records) AS q
  FROM ({SERIES_SQL}) GROUP BY 1)""", floats="pass_rate quarantine_rate", ints="total_records passed_records quarantine_records", digits=2)
def _(c: Inputs) -> DataFrame:
    return quality.quality_overall(_series(c))


@query("d13_quality_latest", f"""SELECT object_name, snapshot_timestamp, total_records, pass_rate, quarantine_rate FROM ({SERIES_SQL})
  QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY snapshot_timestamp DESC) = 1""", floats="pass_rate quarantine_rate", digits=2)
def _(c: Inputs) -> DataFrame:
    return quality.quality_latest(_series(c))


@query("d14_quality_grade", """SELECT doc_id, CASE WHEN s >= 95 THEN '優秀' WHEN s >= 90 THEN '良好' WHEN s >= 80 THEN '普通' WHEN s >= 70 THEN '要改善' ELSE '要緊急対応' END AS grade
  FROM (SELECT doc_id, 60 + n_chars % 41 AS s FROM documents)""")
def _(c: Inputs) -> DataFrame:
    return c.table("documents").select("doc_id", quality_grade(60 + F.col("n_chars") % 41).alias("grade"))


@query("d15_duplicate_snapshots", """SELECT session_date AS snapshot_date, concat('guild ', guild_id) AS object_name, count(*) AS record_count
  FROM silver_voice GROUP BY 1, 2 HAVING count(*) > 1""")
def _(c: Inputs) -> DataFrame:
    rows = c.voice_fact.select(
        F.col("session_date").alias("snapshot_date"), F.concat(F.lit("guild "), F.col("guild_id").cast("string")).alias("object_name")
    )
    return quality.duplicate_snapshots(rows)


@query("d16_check_unique", """SELECT count(*) AS key_count, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS duplicate_keys, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) = 0 AS is_unique
  FROM (SELECT count(*) AS n FROM gold_channel GROUP BY guild_id, channel_id, category_id)""", ints="duplicate_keys")
def _(c: Inputs) -> DataFrame:
    return check_unique(c.channel_activity, ["guild_id", "channel_id", "category_id"])


# --- history -----------------------------------------------------------------------------------------------
# existing: customers as they were, without those of the furniture segment, who are new; incoming: customers as they are, without
# those of the machinery segment, who have left; customers of the building segment had another balance

OLD_SQL = """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_mktsegment <> 'FURNITURE'"""
NEW_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY'"
V1, V2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _incoming(c: Inputs) -> DataFrame:
    return c.table("customer").filter("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_name", "c_acctbal")


def _history(c: Inputs) -> DataFrame:
    old = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    rows = c.table("customer").filter("c_mktsegment <> 'FURNITURE'").select("c_custkey", "c_name", old.alias("c_acctbal"))
    return scd.scd2_merge(rows, None, ["c_custkey"], V1)


@query("h1_row_hash", """SELECT c_custkey, sha256(to_json({'c_mktsegment': c_mktsegment, 'c_name': c_name, 'c_nationkey': c_nationkey})) AS row_hash FROM customer""")
def _(c: Inputs) -> DataFrame:
    customers = c.table("customer")
    return customers.select("c_custkey", scd.row_hash(customers, exclude=["c_custkey", "c_acctbal"]).alias("row_hash"))


HIST_COLS = f"c_custkey, c_name, c_acctbal, valid_from, valid_to, is_current"
H2_SQL = f"""SELECT c_custkey, c_name, c_acctbal, TIMESTAMP '{V1}' AS valid_from, TIMESTAMP '{V2}' AS valid_to, 0 AS is_current FROM ({OLD_SQL}) o
    WHERE EXISTS (SELECT 1 FROM ({NEW_SQL}) n WHERE n.c_custkey = o.c_custkey AND n.c_acctbal <> o.c_acctbal)
  UNION ALL SELECT *, TIMESTAMP '{V2}', NULL, 1 FROM ({NEW_SQL}) n WHERE NOT EXISTS (SELECT 1 FROM ({OLD_SQL}) o WHERE n.c_custkey = o.c_custkey AND n.c_acctbal = o.c_acctbal)
  UNION ALL SELECT *, TIMESTAMP '{V1}', NULL, 1 FROM ({OLD_SQL}) o WHERE NOT EXISTS (SELECT 1 FROM ({NEW_SQL}) n WHERE n.c_custkey = o.c_custkey AND n.c_acctbal <> o.c_acctbal)"""


@query("h2_scd2_merge", H2_SQL, floats="c_acctbal", ints="is_current")
def _(c: Inputs) -> DataFrame:
    return scd.scd2_merge(_incoming(c), _history(c), ["c_custkey"], V2)


@query("h2_stored_merge", H2_SQL, floats="c_acctbal", ints="is_current")
def _(c: Inputs) -> DataFrame:
    """The same history kept in bucketed tables, of which the second load rewrites only what it changes."""
    name = f"customer_history_{uuid.uuid4().hex}"
    old = _history(c).drop(*scd.HISTORY)
    stored_history.merge_load(c.spark, name, old, ["c_custkey"], V1, buckets=16)
    stored_history.merge_load(c.spark, name, _incoming(c), ["c_custkey"], V2)
    return stored_history.stored_history(c.spark, name)


@query("h3_scd2_as_of", f"SELECT * FROM ({H2_SQL}) WHERE valid_from <= TIMESTAMP '2024-01-15 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15 00:00:00')",
       floats="c_acctbal", ints="is_current")
def _(c: Inputs) -> DataFrame:
    return scd.scd2_as_of(scd.scd2_merge(_incoming(c), _history(c), ["c_custkey"], V2), "2024-01-15 00:00:00")


@query("h3_scd2_current", f"SELECT * FROM ({H2_SQL}) WHERE is_current = 1", floats="c_acctbal", ints="is_current")
def _(c: Inputs) -> DataFrame:
    return scd.scd2_current(scd.scd2_merge(_incoming(c), _history(c), ["c_custkey"], V2))


@query("h4_scd_diff", f"""SELECT CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'missing' WHEN n.c_acctbal = o.c_acctbal THEN 'unchanged' ELSE 'changed' END AS status,
  count(*) AS row_count FROM ({NEW_SQL}) n FULL JOIN ({OLD_SQL}) o ON n.c_custkey = o.c_custkey GROUP BY 1""")
def _(c: Inputs) -> DataFrame:
    return scd.scd_diff(_incoming(c), _history(c), ["c_custkey"])


@query("j8_changed_rows", f"SELECT n.* FROM ({NEW_SQL}) n JOIN ({OLD_SQL}) o ON n.c_custkey = o.c_custkey AND n.c_acctbal <> o.c_acctbal", floats="c_acctbal")
def _(c: Inputs) -> DataFrame:
    return scd.changed_rows(_incoming(c), _history(c), ["c_custkey"])


@query("j9_new_rows", f"SELECT * FROM ({NEW_SQL}) n WHERE NOT EXISTS (SELECT 1 FROM ({OLD_SQL}) o WHERE n.c_custkey = o.c_custkey)", floats="c_acctbal")
def _(c: Inputs) -> DataFrame:
    return scd.new_rows(_incoming(c), _history(c), ["c_custkey"])


@query("j10_unchanged_rows", f"SELECT * FROM ({OLD_SQL}) o WHERE EXISTS (SELECT 1 FROM ({NEW_SQL}) n WHERE n.c_custkey = o.c_custkey AND n.c_acctbal = o.c_acctbal)",
       floats="c_acctbal")
def _(c: Inputs) -> DataFrame:
    return scd.unchanged_rows(_incoming(c), _history(c), ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


# --- prompts -----------------------------------------------------------------------------------------------

TEMPLATE = "[System / Role]\nWrite an announcement.\n\n[Single-parameter Examples]\nTone: calm -> plain words\n\n[Output instruction]\nReturn the text only.\n"
BLOCK_SQL = """concat(chr(10), chr(10), '[Hyperparameter Definitions — この生成の指定値]', chr(10),
  '- このブロックは [User request] 内の文体・長さ・構成・絵文字・CTA の記述より優先する', chr(10), '- Tone: ', tone, chr(10),
  '- Length: medium (short: 〜100字（1〜2文） / medium: 101〜300字（2〜5文） / long: 301字〜（補足・背景あり）)', chr(10), '- Formality: polite', chr(10),
  '- Emoji density: 少なめ (なし=0個 / 少なめ=1〜2個 / 普通=3〜5個 / 多め=6個以上)', chr(10), '- Structure: list', chr(10), '- Call-to-action strength: soft', chr(10))"""
TRIMMED = "trim({}, concat(' ', chr(9), chr(10), chr(13), chr(11), chr(12), chr(12288)))"


@query("m11_build_prompts", f"""SELECT conv_id, turn, concat('[System / Role]', chr(10), 'Write an announcement.', {BLOCK_SQL}, chr(10), chr(10),
  '[Single-parameter Examples]', chr(10), 'Tone: calm -> plain words', CASE WHEN {TRIMMED.format('facts')} <> '' THEN concat(chr(10), chr(10), '[Context facts]', chr(10), {TRIMMED.format('facts')}) ELSE '' END,
  chr(10), chr(10), '[User request (natural language)]', chr(10), {TRIMMED.format('text')}, chr(10), chr(10), '[Output instruction]Return the text only.') AS full_prompt
  FROM (SELECT conv_id, turn, text, role AS tone, CASE WHEN role = 'user' THEN concat('  turn ', turn, chr(10)) WHEN turn > 3 THEN '  ' END AS facts FROM conversations)""")
def _(c: Inputs) -> DataFrame:
    facts_ = F.when(F.col("role") == "user", F.concat(F.lit("  turn "), F.col("turn").cast("string"), F.lit("\n"))).when(F.col("turn") > 3, "  ")
    requests = c.table("conversations").select(
        "conv_id", "turn", F.col("text").alias("user_request"), F.col("role").alias("tone"), facts_.alias("context_facts"),
        *[F.lit(v).alias(k) for k, v in {"length": "medium", "formality": "polite", "emoji_density": "少なめ", "structure": "list", "cta_strength": "soft"}.items()],
    )
    return prompts.build_prompts(requests, TEMPLATE).select("conv_id", "turn", "full_prompt")


def answer_length(texts: list[str]) -> list[str]:
    """Stand-in for a model: the length of the text, an error object for very long ones."""
    return ['{"errorMessage": "too long"}' if len(t) > 2000 else f'{{"result": "{len(t)}"}}' for t in texts]


@query("m12_batch_infer", """SELECT conv_id, turn, CASE WHEN length(text) <= 2000 THEN CAST(length(text) AS VARCHAR) END AS "text",
  CASE WHEN length(text) > 2000 THEN 'too long' END AS error_message, NULL::VARCHAR AS error FROM conversations""")
def _(c: Inputs) -> DataFrame:
    rows = c.table("conversations").select("conv_id", "turn", F.col("text").alias("full_prompt"))
    return prompts.parse_response(prompts.batch_infer(rows, answer_length)).select("conv_id", "turn", "text", "error_message", "error")


@query("ud2_model_rows", """SELECT conv_id, turn, role, text, CASE WHEN length(text) > 2000 THEN '{"errorMessage": "too long"}' ELSE '{"result": "' || length(text) || '"}' END AS response,
  NULL::VARCHAR AS error FROM conversations""")
def _(c: Inputs) -> DataFrame:
    """The same call from SQL, over whole rows."""
    register_model(c.spark, "answer_length", answer_length)
    return c.spark.sql("SELECT * FROM answer_length_rows(TABLE({rows}), 'text')", rows=c.table("conversations"))


@query("w6_top_per_group", "SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5")
def _(c: Inputs) -> DataFrame:
    return top_per_group(c.table("orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 5).select("o_custkey", "o_orderkey", "rank")
