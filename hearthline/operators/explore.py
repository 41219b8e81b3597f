"""Interactive summaries on top of the dashboard tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from hearthline.functions.casts import date_lit, name_or_unknown
from hearthline.functions.stats import exact_medians
from hearthline.operators.dashboards import growth_pct, rolling_weeks
from hearthline.operators.filters import by_categories, by_guild, by_month
from hearthline.operators.gold import MESSAGES


def kpi(category_daily: DataFrame, month: str | None = None, guild: str | None = None, categories: Sequence[str] | None = None) -> DataFrame:
    """Messages and voice hours of the filtered rows; a row without hours falls back to its seconds."""
    rows = by_categories(by_guild(by_month(category_daily, "activity_date", month), guild), categories)
    positive = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    row_hours = F.when(positive("voice_duration_hours") != 0, positive("voice_duration_hours")).otherwise(
        positive("voice_duration_seconds") / 3600.0
    )
    return rows.agg(
        F.coalesce(F.sum("message_count"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum(row_hours), F.lit(0.0)).alias("hours"),
    )


def channel_ranking(
    channel_activity: DataFrame, guild: str | None = None, categories: Sequence[str] | None = None, n: int = 25
) -> DataFrame:
    rows = by_categories(by_guild(channel_activity, guild), categories)
    return (
        rows.groupBy(name_or_unknown("channel_name").alias("name"))
        .agg(F.sum(MESSAGES).alias("value"))
        .orderBy(F.desc("value"), "name")
        .limit(n)
    )


def trend(daily: DataFrame, month: str | None = None, guild: str | None = None) -> DataFrame:
    return by_guild(by_month(daily, "activity_date", month), guild).orderBy("activity_date", "guild_name")


def _options(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    return df.filter(c.isNotNull() & (c != "")).select(c.alias("option")).distinct().orderBy("option")


def month_options(daily: DataFrame) -> DataFrame:
    return _options(daily.select(F.date_format("activity_date", "yyyy-MM").alias("month")), "month")


def guild_options(channel_activity: DataFrame) -> DataFrame:
    return _options(channel_activity, "guild_name")


def category_options(channel_activity: DataFrame, guild: str | None = None) -> DataFrame:
    return _options(by_guild(channel_activity, guild), "category_name")


def top_shares(channel_hhi: DataFrame, n: int = 20) -> DataFrame:
    return (
        channel_hhi.select(F.coalesce("channel_name", F.lit("unknown")).alias("name"), "guild_id", F.col("voice_share_pct").alias("share"))
        .orderBy(F.desc("share"), "name", "guild_id")
        .limit(n)
        .drop("guild_id")
    )


def top_rows(df: DataFrame, order: str, n: int | None = 10) -> DataFrame:
    """First rows by the given order column, or all of them for ``n=None``."""
    ordered = df.orderBy(order, *[c for c in df.columns if c != order])
    return ordered if n is None else ordered.limit(n)


def heatmap(timeslots: DataFrame) -> DataFrame:
    """All 7 x 24 cells with the best score over the guilds, 0 where there is none."""
    spark = timeslots.sparkSession
    grid = spark.range(168).select(
        F.floor(F.col("id") / 24).cast("int").alias("weekday"), (F.col("id") % 24).cast("int").alias("hour_slot")
    )
    cells = timeslots.groupBy("weekday", "hour_slot").agg(F.max("voice_dominant_score").alias("_best"))
    best = F.greatest(F.coalesce(F.col("_best"), F.lit(0.0)), F.lit(0.0))
    return grid.join(cells, ["weekday", "hour_slot"], "left").select("weekday", "hour_slot", best.alias("score"))


def peak_slot(timeslots: DataFrame, as_of: str | date) -> DataFrame:
    """The best scored slot, its voice hours, the number of guilds active in it, and the days to the next
    such weekday (7 if today is one). Slots are compared per cell, so at most 168 rows meet at the end."""
    active = timeslots.filter(F.col("voice_dominant_score") > 0)
    order = F.struct(
        F.col("voice_dominant_score").alias("score"),
        (-F.col("guild_id")).alias("g"),
        F.col("voice_duration_hours").alias("hours"),
    )
    cells = active.groupBy("weekday", "hour_slot").agg(
        F.max(order).alias("best"),
        F.count_distinct(F.nullif(F.col("guild_name"), F.lit(""))).alias("guild_count"),
    )
    wait = (F.col("weekday") - F.weekday(date_lit(as_of)) + 7) % 7
    return (
        cells.orderBy(F.desc("best.score"), F.desc("best.g"), "weekday", "hour_slot")
        .limit(1)
        .select(
            "weekday",
            "hour_slot",
            F.col("best.score").alias("score"),
            F.col("best.hours").alias("voice_hours"),
            "guild_count",
            F.when(wait == 0, 7).otherwise(wait).alias("days_until"),
        )
    )


def session_quadrants(segment: DataFrame) -> DataFrame:
    """Every member with both medians and the side of each: long or short sessions, steady or rare weeks."""
    x = F.coalesce(F.col("avg_session_minutes"), F.lit(0.0))
    y = F.coalesce(F.col("active_weeks"), F.lit(0)).cast("double")
    points = segment.select(
        name_or_unknown("user_name").alias("name"), "user_id", x.alias("avg_session_minutes"), y.alias("active_weeks")
    )
    medians = exact_medians(points, ["avg_session_minutes", "active_weeks"])
    middle = medians.select(F.struct("avg_session_minutes", "active_weeks")).scalar()
    length = F.when(F.col("avg_session_minutes") >= F.col("median_minutes"), "long").otherwise("short")
    pace = F.when(F.col("active_weeks") >= F.col("median_weeks"), "steady").otherwise("rare")
    return (
        points.withColumn("_middle", middle)
        .select("name", "user_id", "avg_session_minutes", "active_weeks",
                F.col("_middle.avg_session_minutes").alias("median_minutes"), F.col("_middle.active_weeks").alias("median_weeks"))
        .withColumn("quadrant", F.concat_ws("-", length, pace))
    )


def wow(df: DataFrame, measure: str, as_of: str | date, day: str = "activity_date") -> DataFrame:
    """A measure's last 7 days, the 7 before, and the growth in percent."""
    weeks = rolling_weeks(df, measure, as_of, day)
    return weeks.withColumn("growth_pct", growth_pct(F.col("this_week"), F.col("last_week")))
