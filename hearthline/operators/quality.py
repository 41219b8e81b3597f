"""Declarative data-quality rules, quarantine, and quality reporting.

A rule set is ``{name: SQL predicate}``; users extend it by adding entries. A predicate that is NULL counts
as violated.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

from hearthline.functions.bands import quality_grade
from hearthline.functions.casts import ntz_lit
from hearthline.functions.clock import DEFAULT_TZ
from hearthline.operators.dedupe import find_duplicates

Rules = Mapping[str, str]

MEASURES = ("message_count_aggregated", "voice_duration_seconds_aggregated")


def _not_null(*columns: str) -> dict[str, str]:
    return {f"{c}_not_null": f"{c} IS NOT NULL" for c in columns}


def _non_negative(*columns: str) -> dict[str, str]:
    return {f"{c}_non_negative": f"{c} >= 0" for c in columns}


def table_rules(tz: str = DEFAULT_TZ) -> dict[str, dict[str, str]]:
    """Rule sets of the silver and gold tables. Rule names are fixed values. Event times are UTC and dates are
    local, so the date rules compare in the zone the facts were built with."""
    local = lambda c: c if tz == "UTC" else f"convert_timezone('UTC', '{tz}', {c})"
    return {
        "message_fact": {"message_date_matches_timestamp": f"DATE({local('timestamp')}) = message_date"},
        "voice_chat_fact": {
            "session_date_matches_joined_at": f"DATE({local('joined_at')}) = session_date",
            "valid_session_duration": "left_at IS NULL OR left_at >= joined_at",
        },
        "activity_by_weekday_hour": _not_null("guild_id", "weekday", "hour_slot") | _non_negative(*MEASURES),
        "activity_daily": _not_null("guild_id", "activity_date") | _non_negative(*MEASURES),
        "user_activity": _not_null("guild_id", "user_id") | _non_negative(*MEASURES),
        "channel_activity": _not_null("guild_id", "channel_id") | _non_negative(*MEASURES),
        "user_voice_summary": _not_null("guild_id", "user_id")
        | {"session_count_aggregated_gte_1": "session_count_aggregated >= 1"}
        | _non_negative(MEASURES[1], "avg_session_duration_seconds_aggregated"),
    }


def holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def violation_counts(rules: Rules) -> list[Column]:
    return [F.coalesce(F.sum(F.when(holds(p), 0).otherwise(1)), F.lit(0)).alias(n) for n, p in rules.items()]


def expect(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """All rows unchanged, and one row per rule with total and violation counts from a single pass."""
    wide = df.agg(F.count("*").alias("total_records"), *violation_counts(rules))
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
    metrics = wide.select("total_records", F.explode(pairs).alias("m")).select(
        F.col("m.rule").alias("rule"), "total_records", F.col("m.violations").alias("violations")
    )
    return df, metrics


def observe(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """The same counts gathered while the rows flow to their sink, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("total_records"), *violation_counts(rules)), seen


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [holds(p) for p in rules.values()]))


def add_quarantine_columns(df: DataFrame, run_ts: str | datetime) -> DataFrame:
    """Empty list of reasons and the run time; validators append to the list."""
    return df.withColumns({"quarantine_reason": F.array().cast("array<string>"), "quarantine_ts": ntz_lit(run_ts)})


def _flag(df: DataFrame, bad: Column, reason: str) -> DataFrame:
    added = F.when(F.coalesce(bad, F.lit(True)), F.array(F.lit(reason))).otherwise(F.array().cast("array<string>"))
    return df.withColumn("quarantine_reason", F.concat("quarantine_reason", added))


def validate_id_column(df: DataFrame, col: str, reason: str | None = None, length: int = 18) -> DataFrame:
    c = F.col(col)
    return _flag(df, c.isNull() | (F.length(c) != length), reason or f"Invalid_{col}")


def validate_name_column(df: DataFrame, col: str, min_length: int = 2, reason: str | None = None) -> DataFrame:
    c = F.trim(F.col(col))
    return _flag(df, c.isNull() | (F.length(c) < max(min_length, 1)), reason or f"Invalid_{col}")


def validate_rules(df: DataFrame, rules: Rules) -> DataFrame:
    return reduce(lambda d, kv: _flag(d, ~holds(kv[1]), kv[0]), rules.items(), df)


def filter_invalid_records(df: DataFrame) -> DataFrame:
    return df.filter(F.size("quarantine_reason") > 0)


def filter_valid_records(df: DataFrame) -> DataFrame:
    return df.filter(F.size("quarantine_reason") == 0).drop("quarantine_reason", "quarantine_ts")


def split_valid(df: DataFrame, rules: Rules, run_ts: str | datetime) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with their reasons; together they are the input."""
    checked = validate_rules(add_quarantine_columns(df, run_ts), rules)
    return filter_valid_records(checked), filter_invalid_records(checked)


def _rate(part: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(part * 100.0 / total).cast("decimal(5,2)")


def quality_summary(tables: Mapping[str, tuple[DataFrame, DataFrame | None]], table_names: Mapping[str, str] | None = None) -> DataFrame:
    """One row per object from its clean rows and its quarantine (None when it has none); the total is both."""
    names = table_names or {}
    counts = []
    for name, (clean, quarantine) in tables.items():
        sides = [clean.select(F.lit(0).alias("q"))]
        if quarantine is not None:
            sides.append(quarantine.select(F.lit(1).alias("q")))
        both = reduce(DataFrame.unionAll, sides)
        counts.append(
            both.agg(
                F.count("*").alias("total_records"),
                F.coalesce(F.sum(1 - F.col("q")), F.lit(0)).alias("passed_records"),
                F.coalesce(F.sum("q"), F.lit(0)).alias("quarantine_records"),
            ).select(F.lit(name).alias("object_name"), F.lit(names.get(name, name)).alias("table_name"), "*")
        )
    total = F.col("total_records")
    return reduce(DataFrame.unionByName, counts).withColumns(
        {"pass_rate": _rate(F.col("passed_records"), total), "quarantine_rate": _rate(F.col("quarantine_records"), total)}
    )


def common_quarantine(quarantines: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Quarantined rows of several objects (table, id column) in one shape."""
    return reduce(
        DataFrame.unionByName,
        [
            q.select(F.lit(name).alias("object_name"), F.col(key).cast("string").alias("record_id"), "quarantine_reason", "quarantine_ts")
            for name, (q, key) in quarantines.items()
        ],
    )


def reason_summary(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.select("object_name", F.explode("quarantine_reason").alias("reason"))
        .groupBy("object_name", "reason")
        .agg(F.count("*").alias("record_count"))
    )


def quarantine_samples(quarantines: Mapping[str, tuple[DataFrame, str]], n: int = 10) -> DataFrame:
    """The first n records of every object by id: a report with a limit per object."""
    parts = [
        common_quarantine({name: q}).select("object_name", "record_id", F.array_join("quarantine_reason", ",").alias("reasons"), "quarantine_ts")
        .orderBy("record_id").limit(n)
        for name, q in quarantines.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def quarantine_details(quarantine: DataFrame, original: DataFrame, key: str, target_columns: Mapping[str, str] | None = None) -> DataFrame:
    """One row per record and reason with the original row; ``target_columns`` names the column each reason
    is about."""
    targets = target_columns or {}
    reasons = quarantine.select(F.col("record_id"), F.explode("quarantine_reason").alias("reason"))
    target = reduce(lambda c, kv: c.when(F.col("reason") == kv[0], kv[1]), targets.items(), F.when(F.lit(False), F.lit("")))
    joined = reasons.join(original, reasons["record_id"] == original[key].cast("string"))
    return joined.withColumn("target_column", target)


def over_threshold(summary: DataFrame, limit: float) -> DataFrame:
    return summary.filter(F.col("quarantine_rate") > limit)


def quality_snapshot(summary: DataFrame, as_of_ts: str | datetime) -> DataFrame:
    """The summary in time-series layout."""
    at = ntz_lit(as_of_ts)
    return summary.select(
        at.alias("snapshot_timestamp"),
        at.cast("date").alias("snapshot_date"),
        "object_name",
        "table_name",
        F.col("total_records").cast("bigint").alias("total_records"),
        F.col("passed_records").cast("bigint").alias("passed_records"),
        F.col("quarantine_records").cast("bigint").alias("quarantine_records"),
        "pass_rate",
        "quarantine_rate",
        at.alias("created_at"),
    )


def quality_trend(timeseries: DataFrame) -> DataFrame:
    """Per object and snapshot: pass rate, the change from the object's previous snapshot, and the grade."""
    w = W.partitionBy("object_name").orderBy("snapshot_timestamp")
    before = F.lag("pass_rate").over(w)
    return timeseries.select(
        "object_name",
        "snapshot_timestamp",
        "pass_rate",
        before.alias("previous_pass_rate"),
        (F.col("pass_rate") - before).alias("pass_rate_change"),
        quality_grade(F.col("pass_rate")).alias("grade"),
    )


def quality_overall(timeseries: DataFrame) -> DataFrame:
    """All objects together, per snapshot date."""
    sums = timeseries.groupBy("snapshot_date").agg(
        *[F.sum(c).alias(c) for c in ("total_records", "passed_records", "quarantine_records")]
    )
    return sums.withColumns(
        {
            "pass_rate": _rate(F.col("passed_records"), F.col("total_records")),
            "quarantine_rate": _rate(F.col("quarantine_records"), F.col("total_records")),
        }
    )


def quality_latest(timeseries: DataFrame) -> DataFrame:
    latest = lambda c: F.max_by(c, "snapshot_timestamp").alias(c)
    return timeseries.groupBy("object_name").agg(
        F.max("snapshot_timestamp").alias("snapshot_timestamp"), latest("total_records"), latest("pass_rate"), latest("quarantine_rate")
    )


def duplicate_snapshots(timeseries: DataFrame) -> DataFrame:
    return find_duplicates(timeseries, ["snapshot_date", "object_name"])
