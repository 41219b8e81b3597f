"""The 18 dashboard questions over silver and gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hearthline.functions.bands import churn_level, churn_score, hhi_status, traffic_light, weekday_label
from hearthline.functions.casts import date_lit
from hearthline.functions.clock import epoch_seconds
from hearthline.operators.gold import MESSAGES, SECONDS

TEXT_CHANNEL, NEWS_CHANNEL = 0, 5


def hours(seconds: str | Column) -> Column:
    return (F.col(seconds) if isinstance(seconds, str) else seconds) / 3600.0


def activity_by_category_daily(message_fact: DataFrame, voice_fact: DataFrame, guild: DataFrame, category: DataFrame) -> DataFrame:
    """Straight from silver: voice counts on the day it began, without cap or split, negatives as 0. Its
    totals therefore differ from activity_daily. Names are joined after the first aggregation by id."""
    day = "activity_date"
    length = F.greatest(epoch_seconds(F.col("left_at")) - epoch_seconds(F.col("joined_at")), F.lit(0)).cast("double")
    written = message_fact.select(F.col("message_date").alias(day), "guild_id", "category_id", F.lit(1).alias("messages"))
    spoken = voice_fact.filter(F.col("left_at").isNotNull()).select(F.col("session_date").alias(day), "guild_id", "category_id", length.alias("seconds"))
    sums = [F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds")]
    facts = written.unionByName(spoken, allowMissingColumns=True).groupBy(day, "guild_id", "category_id").agg(*sums)
    for names in (guild, category):
        facts = facts.join(names.select(names.columns[0], f"{names.columns[0][:-3]}_name"), names.columns[0], "left")
    return facts.groupBy(day, "guild_name", "category_name").agg(*sums).select(
        day, "guild_name", "category_name", F.col("messages").alias("message_count"),
        F.col("seconds").alias("voice_duration_seconds"), hours("seconds").alias("voice_duration_hours"),
    )


def weekday_hour_display(activity_by_weekday_hour: DataFrame) -> DataFrame:
    return activity_by_weekday_hour.withColumns(
        {"weekday_display": weekday_label(F.col("weekday")), "voice_duration_hours": hours(SECONDS)}
    )


def with_voice_hours(gold: DataFrame) -> DataFrame:
    """Every column of activity_daily or user_activity, and voice hours."""
    return gold.withColumn("voice_duration_hours", hours(SECONDS))


def daily_message_trend(activity_daily: DataFrame) -> DataFrame:
    return (
        activity_daily.groupBy("activity_date", "guild_name")
        .agg(F.sum(MESSAGES).alias("message_count"))
        .orderBy("activity_date", "guild_name")
    )


def daily_voice_trend(activity_daily: DataFrame) -> DataFrame:
    return (
        activity_daily.groupBy("activity_date", "guild_name")
        .agg(hours(F.sum(SECONDS)).alias("voice_hours"))
        .orderBy("activity_date", "guild_name")
    )


def summary_kpis(activity_daily: DataFrame) -> DataFrame:
    return activity_daily.agg(F.sum(MESSAGES).alias("total_messages"), hours(F.sum(SECONDS)).alias("total_voice_hours"))


def channel_table(channel_activity: DataFrame) -> DataFrame:
    return channel_activity


def latest_channels(channels: DataFrame) -> DataFrame:
    """Text and news channels of the newest snapshot."""
    newest = channels.agg(F.max("snapshot_date")).scalar()
    return (
        channels.filter((F.col("snapshot_date") == newest) & F.col("channel_type").isin(TEXT_CHANNEL, NEWS_CHANNEL))
        .select("channel_id", "channel_name", "category_id")
        .orderBy("channel_name", "channel_id")
    )


def _ranking(user_activity: DataFrame, measure: Column, name: str, by: str, n: int) -> DataFrame:
    keys = ["user_name"] if by == "user_name" else ["user_id", "user_name"]
    return user_activity.groupBy(*keys).agg(measure.alias(name)).orderBy(F.desc(name), *keys).limit(n)


def message_ranking(user_activity: DataFrame, by: str = "user_name", n: int = 25) -> DataFrame:
    """Namesakes are merged unless ``by="user_id"``; ties end in name order."""
    return _ranking(user_activity, F.sum(MESSAGES), "message_count", by, n)


def voice_ranking(user_activity: DataFrame, by: str = "user_name", n: int = 25) -> DataFrame:
    return _ranking(user_activity, hours(F.sum(SECONDS)), "voice_hours", by, n)


def active_timeslots(activity_by_weekday_hour: DataFrame) -> DataFrame:
    """Weighted share of each guild's busiest slot, NULL where a maximum is 0, and the slot's voice rank.
    A guild has at most 168 slots, so the window partitions are small whatever the data size."""
    guild = W.partitionBy("guild_id")
    share = lambda c: F.col(c) / F.nullif(F.max(c).over(guild), F.lit(0))
    return activity_by_weekday_hour.select(
        "guild_id",
        "guild_name",
        "weekday",
        "hour_slot",
        weekday_label(F.col("weekday")).alias("weekday_display"),
        MESSAGES,
        SECONDS,
        hours(SECONDS).alias("voice_duration_hours"),
        (F.lit(0.9) * share(SECONDS) + F.lit(0.1) * share(MESSAGES)).alias("voice_dominant_score"),
        F.rank().over(guild.orderBy(F.desc(SECONDS))).alias("voice_slot_rank"),
    )


def channel_hhi(channel_activity: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Voice share of each channel and the concentration index (sum of squared shares x 10000), over all
    guilds as one market or, with ``partition_by="guild_id"``, one market per guild.

    Sum of squares / square of the sum gives the index from the same aggregate as the total.
    """
    used = channel_activity.filter(F.col(SECONDS) > 0)
    x = F.col(SECONDS)
    measures = [F.sum(x).alias("_total"), F.sum(x * x).alias("_squares")]
    if partition_by is None:
        market = used.agg(*measures).select(F.struct("_total", "_squares")).scalar()
        with_total = used.withColumn("_market", market).select("*", "_market._total", "_market._squares")
    else:
        with_total = used.join(used.groupBy(partition_by).agg(*measures), partition_by)
    total = F.nullif(F.col("_total"), F.lit(0.0))
    index = F.col("_squares") / (total * total) * 10000
    return with_total.select(
        "guild_id",
        "guild_name",
        "channel_name",
        "category_name",
        hours(SECONDS).alias("voice_hours"),
        (x / total * 100).alias("voice_share_pct"),
        index.alias("voice_channel_hhi"),
        hhi_status(index).alias("hhi_status"),
    ).orderBy(F.desc("voice_share_pct"), "guild_id", "channel_name")


def churn_risk(user_voice_summary: DataFrame, as_of: str | date, n: int | None = 30) -> DataFrame:
    """Members with two sessions or more by time since the last one; ``n=None`` lists all."""
    days = F.datediff(date_lit(as_of), F.col("last_voice_session_date"))
    out = (
        user_voice_summary.filter(F.col("session_count_aggregated") >= 2)
        .select(
            "guild_id",
            "user_id",
            "user_name",
            "last_voice_session_date",
            days.alias("days_since_last_voice"),
            "session_count_aggregated",
            hours(SECONDS).alias("voice_hours_total"),
            churn_score(days).alias("churn_risk_score"),
            churn_level(days).alias("churn_risk_level"),
        )
        .orderBy(F.desc("churn_risk_score"), F.desc("days_since_last_voice"), "user_id", "guild_id")
    )
    return (out if n is None else out.limit(n)).drop("guild_id", "user_id")


def ltv_ranking(user_voice_summary: DataFrame, n: int = 20) -> DataFrame:
    total = hours(SECONDS)
    rate = F.col("active_week_count_aggregated") / F.nullif(F.col("tenure_weeks_aggregated"), F.lit(0.0))
    return (
        user_voice_summary.filter(F.col("tenure_weeks_aggregated") >= 2)
        .select(
            "guild_id",
            "user_name",
            "user_id",
            total.alias("voice_hours_total"),
            "active_week_count_aggregated",
            "tenure_weeks_aggregated",
            (total * rate).alias("voice_ltv_score"),
        )
        .orderBy(F.desc_nulls_last("voice_ltv_score"), "user_id", "guild_id")
        .limit(n)
        .drop("guild_id")
    )


def session_segment(user_voice_summary: DataFrame) -> DataFrame:
    return user_voice_summary.filter(F.col("session_count_aggregated") >= 2).select(
        "user_name",
        "user_id",
        (F.col("avg_session_duration_seconds_aggregated") / 60.0).alias("avg_session_minutes"),
        F.col("active_week_count_aggregated").alias("active_weeks"),
        "session_count_aggregated",
        hours(SECONDS).alias("voice_hours_total"),
    )


def weekday_summary(activity_by_weekday_hour: DataFrame) -> DataFrame:
    """Seven rows; the windows without partition key only ever see one row per weekday."""
    per_day = activity_by_weekday_hour.groupBy("weekday").agg(hours(F.sum(SECONDS)).alias("daily_voice_hours"))
    best = F.max("daily_voice_hours").over(W.partitionBy())
    return per_day.select(
        "weekday",
        weekday_label(F.col("weekday")).alias("weekday_label"),
        "daily_voice_hours",
        (F.col("daily_voice_hours") / F.nullif(best, F.lit(0.0))).alias("voice_day_score"),
        F.rank().over(W.orderBy("daily_voice_hours")).alias("low_voice_rank"),
    ).orderBy("weekday")


def rolling_weeks(df: DataFrame, measure: str, as_of: str | date, day: str = "activity_date") -> DataFrame:
    """One row: the measure over the 7 days up to ``as_of`` and over the 7 days before them; 0 where a week has
    no rows, NULL only if the whole table has none."""
    today, d = date_lit(as_of), F.col(day)
    total = lambda first, last: F.sum(
        F.when(d.between(F.date_sub(today, first), F.date_sub(today, last)), F.col(measure)).otherwise(0)
    )
    return df.agg(total(6, 0).alias("this_week"), total(13, 7).alias("last_week"))


def growth_pct(this: Column, last: Column) -> Column:
    return F.when(last.isNotNull() & (last != 0), (this - last) / last * 100)


def weekly_kpi(activity_daily: DataFrame, as_of: str | date) -> DataFrame:
    """Voice hours of the last 7 days against the 7 before, growth and traffic light."""
    out = rolling_weeks(activity_daily, SECONDS, as_of).select(
        hours("this_week").alias("this_week_voice_hours"), hours("last_week").alias("last_week_voice_hours")
    )
    growth = growth_pct(F.col("this_week_voice_hours"), F.col("last_week_voice_hours"))
    return out.withColumn("voice_growth_rate_pct", growth).withColumn(
        "voice_health_signal", traffic_light(F.col("voice_growth_rate_pct"))
    )
