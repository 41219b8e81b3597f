"""Independent ANSI SQL for the same answers, composed from named views.

``sql("SELECT ... FROM gold_daily")`` adds every view the text mentions, and the views those mention, as CTEs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def view(name: str, text: str) -> None:
    VIEWS[name] = " ".join(text.split())


def _mentioned(text: str) -> list[str]:
    return [n for n in VIEWS if re.search(rf"\b{n}\b", text)]


def sql(text: str) -> str:
    """The statement with its views in dependency order (a view may only mention earlier ones)."""
    needed: set[str] = set()
    todo = _mentioned(text)
    while todo:
        n = todo.pop()
        if n not in needed:
            needed.add(n)
            todo += [m for m in _mentioned(VIEWS[n]) if m != n]
    body = " ".join(text.split())
    if not needed:
        return body
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed)
    return f"WITH {ctes} {body}"


CHAT = """CAST(100 + event_id % 25 AS VARCHAR) AS channel_id,
  CASE WHEN event_id % 25 >= 22 THEN NULL ELSE CAST(10 + (event_id % 25) % 5 AS BIGINT) END AS category_id,
  CAST(1 + (event_id % 25) % 3 AS VARCHAR) AS guild_id, CAST(user_id AS VARCHAR) AS user_id,
  CONCAT('user_', CAST(user_id % 120 AS VARCHAR)) AS user_name"""

view("fx_messages", f"""SELECT CAST(event_id AS VARCHAR) AS message_id, {CHAT}, props AS content, ts AS event_ts,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 3 AS INT) END AS attachment_count,
  CAST(event_id % 4 AS INT) AS reaction_count, event_id % 11 = 0 AS is_pinned
  FROM events WHERE event_type IN ('click', 'view', 'error')""")
view("dirty_messages", """SELECT * REPLACE (CASE WHEN CAST(message_id AS BIGINT) % 31 = 0 THEN 'bad-' || message_id
    WHEN CAST(message_id AS BIGINT) % 37 = 0 THEN NULL ELSE message_id END AS message_id) FROM fx_messages
  UNION ALL SELECT * REPLACE (NULL::TIMESTAMP AS event_ts, 'worse copy' AS content) FROM fx_messages WHERE CAST(message_id AS BIGINT) % 29 = 0
    AND CAST(message_id AS BIGINT) % 31 <> 0 AND CAST(message_id AS BIGINT) % 37 <> 0""")
view("fx_voice", f"""SELECT CONCAT(CAST(user_id AS VARCHAR), '_', CAST(event_id AS VARCHAR)) AS session_id, {CHAT}, ts AS joined_at,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ts + to_seconds(-600)
    WHEN event_id % 83 = 0 THEN ts + to_seconds(108000) ELSE ts + to_seconds(CAST(floor(value * 60) AS INT)) END AS left_at
  FROM events WHERE event_type IN ('purchase', 'signup')""")
view("fx_channels", """SELECT s.snap AS snapshot_date, CAST(1 + n_nationkey % 3 AS VARCHAR) AS guild_id,
  CONCAT('guild_', CAST(1 + n_nationkey % 3 AS VARCHAR)) AS guild_name, CAST(100 + n_nationkey AS VARCHAR) AS channel_id,
  CASE WHEN n_nationkey % 4 = 3 THEN 2 WHEN n_nationkey % 4 = 2 THEN 5 ELSE 0 END AS channel_type, n_name AS channel_name,
  CASE WHEN n_nationkey >= 22 THEN NULL ELSE CAST(10 + n_nationkey % 5 AS BIGINT) END AS category_id
  FROM nation, (SELECT '2024-01-30' AS snap UNION ALL SELECT '2024-01-31') s
  UNION ALL SELECT s.snap, '1', 'guild_1', CAST(10 + r_regionkey AS VARCHAR), 4,
  CASE WHEN s.snap = '2024-01-30' AND r_regionkey = 0 THEN 'OLD NAME' ELSE r_name END, NULL
  FROM region, (SELECT '2024-01-30' AS snap UNION ALL SELECT '2024-01-31') s
  UNION ALL SELECT s.snap, CAST(1 + c_nationkey % 3 AS VARCHAR), CONCAT('guild_', CAST(1 + c_nationkey % 3 AS VARCHAR)), CAST(1000000 + c_custkey AS VARCHAR),
  CASE c_mktsegment WHEN 'BUILDING' THEN 4 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 5 ELSE 0 END,
  CASE WHEN s.snap = '2024-01-30' THEN CONCAT('zz ', c_name) ELSE c_name END,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(10 + c_nationkey % 5 AS BIGINT) END
  FROM customer, (SELECT '2024-01-30' AS snap UNION ALL SELECT '2024-01-31') s""")
view("fx_voice_events", """SELECT guild_id, user_id, channel_id, 'join' AS kind, joined_at AS ts FROM fx_voice WHERE category_id IS NOT NULL
  UNION ALL SELECT guild_id, user_id, channel_id, 'leave', left_at FROM fx_voice WHERE left_at >= joined_at""")
view("fx_opportunity", """SELECT o_orderkey AS opportunity_id, o_custkey AS account_id, o_totalprice AS amount,
  o_orderstatus <> 'O' AS is_closed, o_orderstatus = 'F' AS is_won, CAST(o_orderdate AS DATE) AS created_date,
  CAST(o_orderdate + to_days(CAST(o_orderkey % 180 AS INT)) AS DATE) AS close_date, o_orderpriority AS stage_name,
  n_name AS billing_state, c_mktsegment AS industry
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
view("fx_prediction", """SELECT o_orderkey AS opportunity_id, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS win_probability,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate + to_days(CAST(200 + o_orderkey % 300 AS INT)) AS DATE) END AS predicted_close_date
  FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""")
view("fx_target", """SELECT CAST(date_trunc('month', close_date) AS DATE) AS period, sum(amount) AS target_revenue
  FROM fx_opportunity GROUP BY 1""")
view("fx_history", """SELECT l_orderkey AS opportunity_id, l_returnflag AS stage_name, l_extendedprice AS amount, l_shipdate AS changed_at FROM lineitem""")
view("fx_activity", """SELECT user_id AS account_id, CASE event_type WHEN 'signup' THEN 'task' WHEN 'purchase' THEN 'meeting' ELSE 'event' END AS activity_type,
  CAST(ts AS DATE) AS activity_date, event_id % 3 = 0 AS is_open FROM events""")
view("fx_unit", """SELECT DISTINCT o_custkey AS account_id, l_partkey AS product_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")

# silver, Tokyo dates
view("silver_message", """SELECT TRY_CAST(message_id AS BIGINT) AS message_id, TRY_CAST(channel_id AS BIGINT) AS channel_id,
  TRY_CAST(guild_id AS BIGINT) AS guild_id, TRY_CAST(user_id AS BIGINT) AS user_id, category_id, content, event_ts AS "timestamp",
  coalesce(attachment_count, 0) AS attachment_count, coalesce(reaction_count, 0) AS reaction_count, coalesce(is_pinned, false) AS is_pinned,
  CAST(event_ts + INTERVAL 9 HOUR AS DATE) AS message_date FROM fx_messages
  WHERE message_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY event_ts DESC) = 1""")
view("silver_voice", """SELECT session_id, TRY_CAST(channel_id AS BIGINT) AS channel_id, TRY_CAST(guild_id AS BIGINT) AS guild_id,
  TRY_CAST(user_id AS BIGINT) AS user_id, category_id, joined_at, left_at, CAST(joined_at + INTERVAL 9 HOUR AS DATE) AS session_date
  FROM fx_voice WHERE session_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY joined_at DESC) = 1""")
view("silver_guild", """SELECT TRY_CAST(guild_id AS BIGINT) AS guild_id, max(guild_name) AS guild_name FROM fx_channels
  WHERE TRY_CAST(guild_id AS BIGINT) IS NOT NULL GROUP BY 1""")
view("silver_category", """SELECT CAST(channel_id AS BIGINT) AS category_id, arg_max(channel_name, snapshot_date) AS category_name
  FROM fx_channels WHERE channel_type = 4 GROUP BY 1""")
view("silver_channel", """SELECT CAST(channel_id AS BIGINT) AS channel_id, max(CAST(guild_id AS BIGINT)) AS guild_id, max(channel_type) AS channel_type,
  max(channel_name) AS channel_name, max(category_id) AS category_id FROM fx_channels WHERE channel_type <> 4 GROUP BY 1""")
view("silver_user", """SELECT CAST(user_id AS BIGINT) AS user_id, max(user_name) AS user_name
  FROM (SELECT user_id, user_name FROM fx_messages UNION ALL SELECT user_id, user_name FROM fx_voice) GROUP BY 1""")

# gold
view("closed_voice", """SELECT session_id, guild_id, channel_id, category_id, user_id, joined_at, least(left_at, joined_at + INTERVAL 24 HOUR) AS left_at,
  CAST(datediff('second', joined_at, least(left_at, joined_at + INTERVAL 24 HOUR)) AS DOUBLE) AS secs
  FROM silver_voice WHERE left_at >= joined_at AND guild_id IS NOT NULL""")
view("hour_pieces", """SELECT session_id, guild_id, b, CAST(datediff('second', greatest(j, b), least(l, b + INTERVAL 1 HOUR)) AS DOUBLE) AS secs
  FROM (SELECT session_id, guild_id, joined_at + INTERVAL 9 HOUR AS j, left_at + INTERVAL 9 HOUR AS l,
    unnest(generate_series(date_trunc('hour', joined_at + INTERVAL 9 HOUR), date_trunc('hour', left_at + INTERVAL 9 HOUR), INTERVAL 1 HOUR)) AS b
    FROM closed_voice)""")
view("day_pieces", """SELECT session_id, guild_id, CAST(b AS DATE) AS d, CAST(datediff('second', greatest(j, b), least(l, b + INTERVAL 1 DAY)) AS DOUBLE) AS secs
  FROM (SELECT session_id, guild_id, joined_at + INTERVAL 9 HOUR AS j, left_at + INTERVAL 9 HOUR AS l,
    unnest(generate_series(date_trunc('day', joined_at + INTERVAL 9 HOUR), date_trunc('day', left_at + INTERVAL 9 HOUR), INTERVAL 1 DAY)) AS b
    FROM closed_voice)""")
MC, VS = "message_count_aggregated", "voice_duration_seconds_aggregated"
BOTH = f"CAST(coalesce(m.n, 0) AS BIGINT) AS {MC}, coalesce(v.s, 0.0) AS {VS}"
view("gold_wh", f"""SELECT guild_id, guild_name, CAST(weekday AS INT) AS weekday, CAST(hour_slot AS INT) AS hour_slot, {BOTH}
  FROM (SELECT guild_id, isodow("timestamp" + INTERVAL 9 HOUR) - 1 AS weekday, hour("timestamp" + INTERVAL 9 HOUR) AS hour_slot, count(*) AS n
    FROM silver_message WHERE guild_id IS NOT NULL GROUP BY 1, 2, 3) m
  FULL JOIN (SELECT guild_id, isodow(b) - 1 AS weekday, hour(b) AS hour_slot, sum(secs) AS s FROM hour_pieces WHERE secs > 0 GROUP BY 1, 2, 3) v
    USING (guild_id, weekday, hour_slot) LEFT JOIN silver_guild USING (guild_id)""")
view("gold_daily", f"""SELECT guild_id, guild_name, activity_date, {BOTH}
  FROM (SELECT guild_id, message_date AS activity_date, count(*) AS n FROM silver_message WHERE guild_id IS NOT NULL GROUP BY 1, 2) m
  FULL JOIN (SELECT guild_id, d AS activity_date, sum(secs) AS s FROM day_pieces WHERE secs > 0 GROUP BY 1, 2) v
    USING (guild_id, activity_date) LEFT JOIN silver_guild USING (guild_id)""")
view("gold_user", f"""SELECT guild_id, guild_name, CAST(user_id AS VARCHAR) AS user_id, user_name, {BOTH}
  FROM (SELECT guild_id, user_id, count(*) AS n FROM silver_message WHERE user_id IS NOT NULL AND guild_id IS NOT NULL GROUP BY 1, 2) m
  FULL JOIN (SELECT guild_id, user_id, sum(secs) AS s FROM closed_voice GROUP BY 1, 2) v USING (guild_id, user_id)
  LEFT JOIN silver_user USING (user_id) LEFT JOIN silver_guild USING (guild_id)""")
NAMES = """LEFT JOIN silver_guild g ON g.guild_id = x.guild_id LEFT JOIN silver_channel c ON c.channel_id = x.channel_id
  LEFT JOIN silver_category k ON k.category_id = x.category_id"""
SHOWN = f"""x.guild_id, g.guild_name, CAST(x.channel_id AS VARCHAR) AS channel_id, CAST(x.category_id AS VARCHAR) AS category_id,
  c.channel_name, k.category_name, x.{MC}, x.{VS}"""
view("channel_sides", """SELECT guild_id, channel_id, category_id, count(*) AS n, NULL AS s FROM silver_message
  WHERE channel_id IS NOT NULL AND guild_id IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL SELECT guild_id, channel_id, category_id, NULL, sum(secs) FROM closed_voice GROUP BY 1, 2, 3""")
view("gold_channel", f"""SELECT {SHOWN} FROM (SELECT guild_id, channel_id, category_id, {BOTH}
  FROM (SELECT * FROM channel_sides WHERE n IS NOT NULL) m FULL JOIN (SELECT * FROM channel_sides WHERE n IS NULL) v
  USING (guild_id, channel_id, category_id)) x {NAMES}""")
view("gold_channel_null_safe", f"""SELECT {SHOWN} FROM (SELECT guild_id, channel_id, category_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS {MC},
  CAST(coalesce(sum(s), 0) AS DOUBLE) AS {VS} FROM channel_sides GROUP BY 1, 2, 3) x {NAMES}""")
view("gold_summary", f"""SELECT guild_id, guild_name, CAST(user_id AS VARCHAR) AS user_id, user_name, session_count_aggregated, {VS},
  avg_session_duration_seconds_aggregated, first_voice_session_date, last_voice_session_date, active_week_count_aggregated,
  CAST(greatest(datediff('day', first_voice_session_date, DATE '2024-02-01'), 0) AS DOUBLE) / 7.0 AS tenure_weeks_aggregated
  FROM (SELECT guild_id, user_id, count(*) AS session_count_aggregated, sum(secs) AS {VS}, avg(secs) AS avg_session_duration_seconds_aggregated,
    min(CAST(joined_at + INTERVAL 9 HOUR AS DATE)) AS first_voice_session_date, max(CAST(joined_at + INTERVAL 9 HOUR AS DATE)) AS last_voice_session_date,
    count(DISTINCT date_trunc('week', joined_at + INTERVAL 9 HOUR)) AS active_week_count_aggregated
    FROM closed_voice WHERE user_id IS NOT NULL GROUP BY 1, 2)
  LEFT JOIN silver_user USING (user_id) LEFT JOIN silver_guild USING (guild_id)""")
WEEKDAYS = """CASE weekday WHEN 0 THEN '1. 月' WHEN 1 THEN '2. 火' WHEN 2 THEN '3. 水' WHEN 3 THEN '4. 木' WHEN 4 THEN '5. 金'
  WHEN 5 THEN '6. 土' WHEN 6 THEN '7. 日' END"""
view("dash_category", f"""SELECT activity_date, guild_name, category_name, CAST(sum(n) AS BIGINT) AS message_count, sum(s) AS voice_duration_seconds,
  sum(s) / 3600.0 AS voice_duration_hours FROM (
    SELECT message_date AS activity_date, guild_id, category_id, count(*) AS n, CAST(0 AS DOUBLE) AS s FROM silver_message GROUP BY 1, 2, 3
    UNION ALL SELECT session_date, guild_id, category_id, 0, CAST(sum(greatest(datediff('second', joined_at, left_at), 0)) AS DOUBLE)
    FROM silver_voice WHERE left_at IS NOT NULL GROUP BY 1, 2, 3) u
  LEFT JOIN silver_guild USING (guild_id) LEFT JOIN silver_category USING (category_id) GROUP BY 1, 2, 3""")
view("dash_slots", f"""SELECT guild_id, guild_name, weekday, hour_slot, {WEEKDAYS} AS weekday_display, {MC}, {VS}, {VS} / 3600.0 AS voice_duration_hours,
  0.9::DOUBLE * ({VS} / nullif(max({VS}) OVER (PARTITION BY guild_id), 0)) + 0.1::DOUBLE * ({MC}::DOUBLE / nullif(max({MC}) OVER (PARTITION BY guild_id), 0)) AS voice_dominant_score,
  CAST(rank() OVER (PARTITION BY guild_id ORDER BY {VS} DESC) AS INT) AS voice_slot_rank FROM gold_wh""")
view("dash_hhi", f"""SELECT guild_id, guild_name, channel_name, category_name, {VS} / 3600.0 AS voice_hours,
  {VS} / t.total * 100 AS voice_share_pct, t.squares / (t.total * t.total) * 10000 AS hhi
  FROM gold_channel, (SELECT sum({VS}) AS total, sum({VS} * {VS}) AS squares FROM gold_channel WHERE {VS} > 0) t WHERE {VS} > 0""")
view("dash_segment", f"""SELECT user_name, user_id, avg_session_duration_seconds_aggregated / 60.0 AS avg_session_minutes,
  active_week_count_aggregated AS active_weeks, session_count_aggregated, {VS} / 3600.0 AS voice_hours_total
  FROM gold_summary WHERE session_count_aggregated >= 2""")

# sales
view("fx_churn", "SELECT o_orderkey AS opportunity_id, round(1 - CAST(o_orderkey % 100 AS DOUBLE) / 100, 2) AS churn_risk_score FROM orders")
view("open_due", """SELECT o.*, p.win_probability AS p, coalesce(p.predicted_close_date, o.close_date) AS due
  FROM fx_opportunity o JOIN fx_prediction p USING (opportunity_id)
  WHERE NOT o.is_closed AND coalesce(p.predicted_close_date, o.close_date) >= DATE '2001-08-02'""")
view("scored_open", """SELECT o.*, c.churn_risk_score, c.churn_risk_score * 100 AS risk_score,
  CASE WHEN c.churn_risk_score >= 0.7 THEN 'Critical' WHEN c.churn_risk_score >= 0.4 THEN 'High' ELSE 'Medium' END AS risk_level,
  c.churn_risk_score * 100 * o.amount / 1000000 AS priority_score
  FROM fx_opportunity o JOIN fx_churn c USING (opportunity_id) WHERE NOT o.is_closed""")
view("ab_assigned", """SELECT account_id, product_id, 'test_2001' AS test_id, DATE '2001-01-15' AS test_start_date,
  CASE WHEN concat('0x', substr(md5(concat('test_2001', '|', account_id, '|', product_id)), 1, 8))::BIGINT / 4294967296.0 < 0.5
    THEN 'treatment' ELSE 'control' END AS test_group FROM fx_unit""")
view("ab_results", """SELECT a.*, h.purchase_date, h.purchase_amount, h.opportunity_id, h.opportunity_id IS NOT NULL AS is_purchased
  FROM ab_assigned a LEFT JOIN (SELECT account_id, close_date AS purchase_date, CAST(amount AS DECIMAL(18,2)) AS purchase_amount, opportunity_id
    FROM fx_opportunity WHERE is_won AND close_date BETWEEN DATE '2001-01-15' AND DATE '2001-01-15' + INTERVAL 90 DAY
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY close_date, opportunity_id) = 1) h USING (account_id)""")
view("survival", """SELECT *, datediff('day', created_date, CASE WHEN is_closed THEN close_date ELSE DATE '2001-08-02' END) AS duration_days,
  CASE WHEN is_closed AND NOT is_won THEN 1 ELSE 0 END AS event_lost FROM fx_opportunity""")
