"""Declared schemas of every stored table.

Event times are TIMESTAMP_NTZ holding UTC wall time, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "RATE": T.DecimalType(5, 2),
    "MONEY": T.DecimalType(18, 2),
}


def ddl(text: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; unlike StructType.fromDDL it needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


MESSAGES_RAW = ddl(
    "message_id STRING, channel_id STRING, channel_name STRING, category_id BIGINT, guild_id STRING, "
    "guild_name STRING, user_id STRING, user_name STRING, content STRING, timestamp STRING, "
    "edited_timestamp STRING, attachment_count INT, reaction_count INT, is_pinned BOOLEAN"
)
VOICE_RAW = ddl(
    "session_id STRING, channel_id STRING, channel_name STRING, category_id BIGINT, user_id STRING, "
    "user_name STRING, guild_id STRING, guild_name STRING, joined_at STRING, left_at STRING"
)
CHANNELS_RAW = ddl(
    "snapshot_date STRING, guild_id STRING, guild_name STRING, channel_id STRING, channel_type INT, "
    "channel_name STRING, category_id BIGINT, parent_id BIGINT"
)
VOICE_EVENTS = ddl("guild_id STRING, user_id STRING, channel_id STRING, kind STRING, ts TIMESTAMP")

GUILD_DIM = ddl("guild_id BIGINT, guild_name STRING")
CATEGORY_DIM = ddl("category_id BIGINT, category_name STRING")
CHANNEL_DIM = ddl(
    "channel_id BIGINT, guild_id BIGINT, channel_type INT, channel_name STRING, category_id BIGINT"
)
USER_DIM = ddl("user_id BIGINT, user_name STRING")
MESSAGE_FACT = ddl(
    "message_id BIGINT, channel_id BIGINT, guild_id BIGINT, user_id BIGINT, category_id BIGINT, "
    "content STRING, timestamp TIMESTAMP_NTZ, attachment_count INT, reaction_count INT, "
    "is_pinned BOOLEAN, message_date DATE"
)
VOICE_CHAT_FACT = ddl(
    "session_id BIGINT, channel_id BIGINT, guild_id BIGINT, user_id BIGINT, category_id BIGINT, "
    "joined_at TIMESTAMP_NTZ, left_at TIMESTAMP_NTZ, session_date DATE"
)

ACTIVITY_BY_WEEKDAY_HOUR = ddl(
    "guild_id BIGINT, guild_name STRING, weekday INT, hour_slot INT, "
    "message_count_aggregated BIGINT, voice_duration_seconds_aggregated DOUBLE"
)
ACTIVITY_DAILY = ddl(
    "guild_id BIGINT, guild_name STRING, activity_date DATE, "
    "message_count_aggregated BIGINT, voice_duration_seconds_aggregated DOUBLE"
)
USER_ACTIVITY = ddl(
    "guild_id BIGINT, guild_name STRING, user_id STRING, user_name STRING, "
    "message_count_aggregated BIGINT, voice_duration_seconds_aggregated DOUBLE"
)
CHANNEL_ACTIVITY = ddl(
    "guild_id BIGINT, guild_name STRING, channel_id STRING, category_id STRING, channel_name STRING, "
    "category_name STRING, message_count_aggregated BIGINT, voice_duration_seconds_aggregated DOUBLE"
)
USER_VOICE_SUMMARY = ddl(
    "guild_id BIGINT, guild_name STRING, user_id STRING, user_name STRING, "
    "session_count_aggregated BIGINT, voice_duration_seconds_aggregated DOUBLE, "
    "avg_session_duration_seconds_aggregated DOUBLE, first_voice_session_date DATE, "
    "last_voice_session_date DATE, active_week_count_aggregated BIGINT, tenure_weeks_aggregated DOUBLE"
)

QUALITY_TIMESERIES = ddl(
    "snapshot_timestamp TIMESTAMP_NTZ, snapshot_date DATE, object_name STRING, table_name STRING, "
    "total_records BIGINT, passed_records BIGINT, quarantine_records BIGINT, pass_rate RATE, "
    "quarantine_rate RATE, created_at TIMESTAMP_NTZ"
)
AB_TEST_RESULTS = ddl(
    "test_id STRING, test_start_date DATE, test_end_date DATE, account_id STRING, product_id STRING, "
    "product_name STRING, test_group STRING, recommendation_rank INT, purchase_score DOUBLE, "
    "recommendation_date DATE, is_purchased BOOLEAN, purchase_date DATE, purchase_amount MONEY, "
    "opportunity_id STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, customer_segment STRING, "
    "product_category STRING, notes STRING"
)
WIN_PREDICTIONS = ddl(
    "opportunity_id BIGINT, win_probability DOUBLE, predicted_close_date DATE, "
    "confidence_interval_lower DOUBLE, confidence_interval_upper DOUBLE, probability_category STRING, "
    "prediction_date TIMESTAMP_NTZ"
)

BRONZE = {"messages_raw": MESSAGES_RAW, "voice_activity_raw": VOICE_RAW, "channels_raw": CHANNELS_RAW}
SILVER = {
    "guild_dim": GUILD_DIM,
    "category_dim": CATEGORY_DIM,
    "channel_dim": CHANNEL_DIM,
    "user_dim": USER_DIM,
    "message_fact": MESSAGE_FACT,
    "voice_chat_fact": VOICE_CHAT_FACT,
}
GOLD = {
    "activity_by_weekday_hour": ACTIVITY_BY_WEEKDAY_HOUR,
    "activity_daily": ACTIVITY_DAILY,
    "user_activity": USER_ACTIVITY,
    "channel_activity": CHANNEL_ACTIVITY,
    "user_voice_summary": USER_VOICE_SUMMARY,
    "data_quality_timeseries": QUALITY_TIMESERIES,
    "ab_test_results": AB_TEST_RESULTS,
    "win_probability_predictions": WIN_PREDICTIONS,
}
LAYER_TABLES = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}

PARTITIONS = {
    "channels_raw": ["snapshot_date"],
    "message_fact": ["message_date"],
    "voice_chat_fact": ["session_date"],
    "activity_daily": ["activity_date"],
    "data_quality_timeseries": ["snapshot_date", "object_name"],
    "ab_test_results": ["test_id", "test_start_date"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, casting safely and filling absent ones with NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def assert_schema(df: DataFrame, schema: T.StructType, extra_ok: bool = False) -> DataFrame:
    """Fail before a write whose columns or types differ from the declaration (order is free)."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    wrong = [n for n, t in want.items() if have.get(n) != t]
    surplus = [] if extra_ok else [n for n in have if n not in want]
    if wrong or surplus:
        raise ValueError(f"schema mismatch: wrong or missing {wrong}, unexpected {surplus}")
    return df
