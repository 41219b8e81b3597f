"""Opportunity features, risk and priority scores, revenue actuals and forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from hearthline.functions.bands import priority_level, probability_category, risk_level, win_probability_rule
from hearthline.functions.casts import date_lit
from hearthline.functions.clock import month_start, quarter_start

BEST, MODERATE, WORST = 0.3, 0.6, 0.9
DEFAULT_PROBABILITY = 0.5
LOOKBACK_DAYS = 30


def variance_ratio(c: str | Column) -> Column:
    """(max - min) / max, NULL where the maximum is 0."""
    top = F.max(c)
    return F.try_divide(top - F.min(c), top)


def opportunity_features(opp: DataFrame, history: DataFrame, as_of: str | date) -> DataFrame:
    today = date_lit(as_of)
    changes = history.groupBy("opportunity_id").agg(
        F.count_distinct("stage_name").alias("stage_change_count"),
        variance_ratio("amount").alias("amount_variance"),
        F.count("*").alias("history_record_count"),
        F.max(F.col("changed_at").cast("date")).alias("_last_change"),
    )
    return opp.join(changes, "opportunity_id", "left").select(
        "opportunity_id",
        F.coalesce("stage_change_count", F.lit(0)).alias("stage_change_count"),
        "amount_variance",
        F.coalesce("history_record_count", F.lit(0)).alias("history_record_count"),
        F.datediff(today, "created_date").alias("days_since_created"),
        F.datediff("close_date", today).alias("days_until_close"),
        F.datediff(today, "_last_change").alias("stage_duration_days"),
    )


def activity_features(activity: DataFrame, as_of: str | date) -> DataFrame:
    """Per account, over the 30 days up to ``as_of``; a task is overdue when open and dated before it."""
    today = date_lit(as_of)
    recent = F.col("activity_date").between(F.date_sub(today, LOOKBACK_DAYS), today)
    kind = F.col("activity_type")
    open_task = (kind == "task") & F.col("is_open")
    n = lambda cond: F.count_if(cond)
    counts = activity.groupBy("account_id").agg(
        F.datediff(today, F.max("activity_date")).alias("days_since_last_activity"),
        n(recent).alias("activity_count_last_30days"),
        n(recent & (kind == "task")).alias("task_count_last_30days"),
        n(recent & (kind == "event")).alias("event_count_last_30days"),
        n(recent & (kind == "meeting")).alias("meeting_count_last_30days"),
        n(open_task).alias("open_task_count"),
        n(open_task & (F.col("activity_date") < today)).alias("overdue_task_count"),
    )
    weekly = F.col("activity_count_last_30days") / float(LOOKBACK_DAYS) * 7
    return counts.withColumn("weekly_activity_frequency", weekly)


def with_rule_probability(opp: DataFrame) -> DataFrame:
    return opp.withColumn("win_probability", win_probability_rule(F.col("stage_name")))


def win_outputs(scored: DataFrame, opp: DataFrame, prediction_ts: Column | None = None) -> DataFrame:
    """Prediction table rows from ``scored`` (opportunities with win_probability). The predicted close is the
    creation date plus the average duration of won deals, or the close date when nothing was won yet."""
    average = opp.filter(F.col("is_closed") & F.col("is_won")).agg(F.avg(F.datediff("close_date", "created_date"))).scalar()
    days = F.floor(average + 0.5).cast("int")
    p = F.col("win_probability")
    out = scored.select(
        "opportunity_id",
        p,
        F.coalesce(F.date_add("created_date", days), F.col("close_date")).alias("predicted_close_date"),
        (p - 0.1).alias("confidence_interval_lower"),
        (p + 0.1).alias("confidence_interval_upper"),
        probability_category(p).alias("probability_category"),
    )
    return out if prediction_ts is None else out.withColumn("prediction_date", prediction_ts)


def with_risk(df: DataFrame, churn: str = "churn_risk_score") -> DataFrame:
    return df.withColumns({"risk_score": F.col(churn) * 100, "risk_level": risk_level(F.col(churn))})


def hybrid_risk(df: DataFrame, churn: str = "churn_risk_score", survival: str = "survival_prob_30d") -> DataFrame:
    """0.6 x churn + 0.4 x (1 - survival); plain churn where no survival estimate exists."""
    s = F.col(survival)
    mixed = F.col(churn) * 0.6 + (1.0 - s) * 0.4
    return df.withColumn("hybrid_risk_score", F.when(s.isNull(), F.col(churn)).otherwise(mixed))


def risk_priority(df: DataFrame, churn: str = "churn_risk_score") -> DataFrame:
    score = F.col(churn) * 100 * F.col("amount") / 1_000_000
    return df.withColumn("priority_score", score).withColumn("priority_level", priority_level(F.col("priority_score")))


def sales_priority(df: DataFrame) -> DataFrame:
    score = F.greatest("upsell_probability", "crosssell_probability") * 100
    return df.withColumn("priority_score", score).withColumn("priority_level", priority_level(F.col("priority_score")))


def _current(opp: DataFrame) -> DataFrame:
    return opp.filter(F.col("is_current") == 1)


def _won(opp: DataFrame) -> DataFrame:
    return _current(opp).filter(F.col("is_closed") & F.col("is_won"))


def _open_predicted(opp: DataFrame, pred: DataFrame, as_of: str | date) -> DataFrame:
    """Open current opportunities with their prediction, due on or after ``as_of``."""
    joined = _current(opp).filter(~F.col("is_closed")).join(
        pred.select("opportunity_id", "win_probability", "predicted_close_date"), "opportunity_id"
    )
    due = F.coalesce("predicted_close_date", "close_date")
    return joined.withColumn("due_date", due).filter(F.col("due_date") >= date_lit(as_of))


def amount_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("amount")).otherwise(0))


def _cases() -> list[Column]:
    p = F.col("win_probability")
    return [
        F.sum(F.col("amount") * p).alias("expected_revenue"),
        amount_if(p >= BEST).alias("best_case_revenue"),
        amount_if(p >= MODERATE).alias("moderate_case_revenue"),
        amount_if(p >= WORST).alias("worst_case_revenue"),
    ]


def monthly_actual(opp: DataFrame, as_of: str | date) -> DataFrame:
    """Won revenue by month of close from six months before ``as_of`` on."""
    recent = _won(opp).filter(F.col("close_date") >= F.add_months(date_lit(as_of), -6))
    return recent.groupBy(month_start(F.col("close_date")).alias("period")).agg(
        F.sum("amount").alias("actual_revenue"), F.count("*").alias("actual_won_count")
    )


def monthly_forecast(opp: DataFrame, pred: DataFrame, as_of: str | date) -> DataFrame:
    return _open_predicted(opp, pred, as_of).groupBy(month_start(F.col("due_date")).alias("period")).agg(
        *_cases(), F.count("*").alias("opportunity_count")
    )


def quarterly_forecast(opp: DataFrame, pred: DataFrame) -> DataFrame:
    """By quarter of close: won revenue, won plus weighted open revenue, cases and probability bands."""
    p, amount = F.col("win_probability"), F.col("amount")
    won, still_open = F.col("is_closed") & F.col("is_won"), ~F.col("is_closed")
    expected = F.when(won, amount).when(still_open, amount * p).otherwise(0)
    return (
        _current(opp).join(pred.select("opportunity_id", "win_probability"), "opportunity_id", "left")
        .groupBy(quarter_start(F.col("close_date")).alias("period"))
        .agg(
            amount_if(won).alias("actual_revenue"),
            F.sum(expected).alias("expected_revenue"),
            amount_if(p >= BEST).alias("best_case_revenue"),
            amount_if(p >= WORST).alias("worst_case_revenue"),
            amount_if(p >= 0.9).alias("prob_90_plus"),
            amount_if((p >= 0.7) & (p < 0.9)).alias("prob_70_90"),
            amount_if((p >= 0.5) & (p < 0.7)).alias("prob_50_70"),
            amount_if((p >= 0.3) & (p < 0.5)).alias("prob_30_50"),
        )
    )


def annual_forecast(opp: DataFrame, pred: DataFrame, targets: DataFrame, as_of: str | date) -> DataFrame:
    """First-half actuals plus second-half forecast for the year of ``as_of``, actuals alone for other years.
    ``targets`` has one row per year start (period, target_revenue)."""
    year_of = lambda c: F.year(c)
    actual = _won(opp).groupBy(year_of("close_date").alias("fiscal_year")).agg(
        F.sum("amount").alias("_actual"), amount_if(F.month("close_date") <= 6).alias("h1_actual")
    )
    second_half = _open_predicted(opp, pred, as_of).filter(
        (year_of("due_date") == year_of(date_lit(as_of))) & (F.month("due_date") > 6)
    )
    forecast = second_half.groupBy(year_of("due_date").alias("fiscal_year")).agg(*_cases())
    full = actual.join(forecast, "fiscal_year", "full")
    has_forecast = F.col("expected_revenue").isNotNull()
    half = F.coalesce("h1_actual", F.lit(0.0))
    whole = lambda c: F.when(has_forecast, half + F.col(c)).otherwise(F.col("_actual"))
    out = full.select(
        "fiscal_year",
        half.alias("h1_actual"),
        whole("expected_revenue").alias("full_year_expected"),
        whole("best_case_revenue").alias("full_year_best_case"),
        whole("worst_case_revenue").alias("full_year_worst_case"),
        F.when(has_forecast, "forecast").otherwise("actual").alias("period_type"),
    )
    yearly = targets.groupBy(year_of("period").alias("fiscal_year")).agg(F.sum("target_revenue").alias("target_revenue"))
    return _against_target(out.join(yearly, "fiscal_year", "left"), F.col("full_year_expected"), with_pct=False)


def _against_target(df: DataFrame, value: Column, with_pct: bool = True) -> DataFrame:
    target = F.col("target_revenue")
    nonzero = F.nullif(target, F.lit(0.0))
    columns = {"achievement_rate": value / nonzero * 100, "variance_to_target": value - target}
    if with_pct:
        columns["variance_to_target_pct"] = (value - target) / nonzero * 100
    return df.withColumns(columns)


def vs_target(df: DataFrame, targets: DataFrame, on: str = "period", value: Column | None = None) -> DataFrame:
    """Achievement and variance of expected (or, without a forecast, actual) revenue. The right grain of
    ``targets`` (month, quarter or year start) is the caller's choice."""
    if value is None:
        known = [c for c in ("expected_revenue", "actual_revenue") if c in df.columns]
        value = F.coalesce(*known)
    return _against_target(df.join(targets.select(on, "target_revenue"), on, "left"), value)


def quarterly_targets(targets: DataFrame) -> DataFrame:
    return targets.groupBy(quarter_start(F.col("period")).alias("period")).agg(F.sum("target_revenue").alias("target_revenue"))


def monthly_view(opp: DataFrame, pred: DataFrame, targets: DataFrame, as_of: str | date) -> DataFrame:
    """Actuals and forecast of each month on one row, against the month's target."""
    both = monthly_actual(opp, as_of).join(monthly_forecast(opp, pred, as_of), "period", "full")
    kind = F.when(F.col("expected_revenue").isNotNull(), "forecast").otherwise("actual")
    return vs_target(both, targets).withColumn("period_type", kind)


def priority_by(opp: DataFrame, pred: DataFrame, dim: str) -> DataFrame:
    """Predicted revenue and open opportunities by region or industry; unknown probability counts as 0.5."""
    joined = _current(opp).filter(~F.col("is_closed")).join(
        pred.select("opportunity_id", "win_probability"), "opportunity_id", "left"
    )
    p = F.coalesce("win_probability", F.lit(DEFAULT_PROBABILITY))
    return joined.groupBy(dim).agg(
        F.sum(F.col("amount") * p).alias("predicted_revenue"), F.count_distinct("opportunity_id").alias("opportunity_count")
    )


def priority_prospects(opp: DataFrame, pred: DataFrame, churn: DataFrame, n: int = 20) -> DataFrame:
    """Open opportunities with the highest risk-weighted amount."""
    rows = (
        _current(opp).filter(~F.col("is_closed"))
        .join(pred.select("opportunity_id", "win_probability"), "opportunity_id")
        .join(churn.select("opportunity_id", "churn_risk_score"), "opportunity_id")
    )
    scored = risk_priority(with_risk(rows)).withColumn("expected_revenue", F.col("amount") * F.col("win_probability"))
    return (
        scored.orderBy(F.desc("priority_score"), "opportunity_id")
        .limit(n)
        .select("opportunity_id", "account_id", "amount", "win_probability", "risk_score", "expected_revenue", "priority_score", "priority_level")
    )


def priority_customers(recommendations: DataFrame) -> DataFrame:
    best = recommendations.groupBy("account_id").agg(F.max("purchase_score").alias("upsell_probability"))
    return sales_priority(best.withColumn("crosssell_probability", F.lit(None).cast("double")))


def rep_actions(opp: DataFrame, churn: DataFrame, factors: DataFrame | None, owner: str) -> DataFrame:
    """Open opportunities of each owner with risk, priority and, where explained, the top factors."""
    rows = _current(opp).filter(~F.col("is_closed")).join(churn.select("opportunity_id", "churn_risk_score"), "opportunity_id")
    scored = risk_priority(with_risk(rows))
    kept = ["opportunity_id", "account_id", "stage_name", "amount", "risk_score", "risk_level", "priority_score", "priority_level"]
    out = scored.select(F.col(owner).alias("owner"), *kept)
    return out if factors is None else out.join(factors, "opportunity_id", "left")


def rep_risk_summary(actions: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    return actions.groupBy("owner").agg(
        F.count("*").alias("opportunity_count"),
        F.count_if(level == "Critical").alias("critical_count"),
        F.count_if(level == "High").alias("high_count"),
        F.count_if(level == "Medium").alias("medium_count"),
        F.sum("amount").alias("open_amount"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("priority_score").alias("max_priority_score"),
    )


def counts_by(actions: DataFrame, dim: str) -> DataFrame:
    return actions.groupBy(dim).agg(F.count("*").alias("opportunity_count"), F.sum("amount").alias("amount"))
