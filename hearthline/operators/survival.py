"""Survival data set, Kaplan-Meier curve, Weibull regression, and covariate hygiene."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hearthline.functions.casts import date_lit

TIMES = (30, 60, 90)


def survival_dataset(opp: DataFrame, as_of: str | date) -> DataFrame:
    """Duration to close (or to ``as_of`` while open), and 1 where the deal was lost."""
    end = F.when(F.col("is_closed"), F.col("close_date")).otherwise(date_lit(as_of))
    lost = F.col("is_closed") & ~F.col("is_won")
    return opp.withColumns(
        {"duration_days": F.datediff(end, "created_date"), "event_lost": F.when(lost, 1).otherwise(0)}
    )


def kaplan_meier(df: DataFrame, group: Sequence[str] = (), duration: str = "duration_days", event: str = "event_lost") -> DataFrame:
    """Survival after every distinct duration. Rows shrink to one per group and day first, so each window
    holds no more rows than there are distinct days."""
    steps = df.groupBy(*group, duration).agg(F.count("*").alias("leaving"), F.sum(event).alias("events"))
    onward = W.partitionBy(*group).orderBy(F.desc(duration))
    so_far = W.partitionBy(*group).orderBy(duration)
    everyone_lost = F.col("events") == F.col("at_risk")
    factor = F.when(~everyone_lost, F.log(1 - F.col("events") / F.col("at_risk")))
    extinct = F.max(everyone_lost).over(so_far)
    return (
        steps.withColumn("at_risk", F.sum("leaving").over(onward))
        .withColumn("survival", F.when(extinct, F.lit(0.0)).otherwise(F.exp(F.sum(factor).over(so_far))))
        .select(*group, duration, "at_risk", "events", "survival")
    )


def survival_probs(
    train: DataFrame,
    score: DataFrame,
    features: Sequence[str],
    times: Sequence[int] = TIMES,
    duration: str = "duration_days",
    event: str = "event_lost",
) -> DataFrame:
    """Every row of ``score`` with columns ``survival_prob_<t>d`` from a Weibull regression on the rows with a positive duration
    and no null, and ``survival_fitted``. Rows with a null feature get NULL; without such rows or without an event there is
    nothing to fit: survival is 1 and ``survival_fitted`` false. Any other failure of the fit is an error."""
    names = [f"survival_prob_{t}d" for t in times]
    usable = train.filter(F.col(duration) > 0).select(
        *features, F.col(duration).cast("double").alias("label"), F.col(event).cast("double").alias("censor")
    ).dropna()
    events = usable.agg(F.coalesce(F.sum("censor"), F.lit(0.0))).first()[0]
    if not events:
        return score.withColumns({n: F.lit(1.0) for n in names} | {"survival_fitted": F.lit(False)})
    stages = [VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep"),
              AFTSurvivalRegression(featuresCol="_features", labelCol="label", censorCol="censor")]
    model = Pipeline(stages=stages).fit(usable).stages[-1]
    # the scale of a row as a built-in expression; a null feature makes it null
    terms = [F.col(c).cast("double") * float(w) for c, w in zip(features, model.coefficients)]
    scale = F.exp(reduce(lambda a, b: a + b, terms, F.lit(float(model.intercept))))
    survive = lambda t: F.exp(-F.pow(F.lit(float(t)) / scale, F.lit(1.0 / model.scale)))
    return score.withColumns({n: survive(t) for n, t in zip(names, times)} | {"survival_fitted": F.lit(True)})


def variance_report(df: DataFrame, columns: Sequence[str], event: str = "event_lost", minimum: float = 1e-6) -> DataFrame:
    """One pass over the data: population variance of each covariate, overall and by event, and whether to
    keep it (every variance above the minimum)."""
    var = lambda c, cond: F.var_pop(c if cond is None else F.when(cond, F.col(c)))
    happened = F.col(event) == 1
    wide = df.agg(
        *[F.struct(var(c, None).alias("overall"), var(c, happened).alias("lost"), var(c, ~happened).alias("kept")).alias(c) for c in columns]
    )
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns])).alias("r"))
    enough = lambda name: F.coalesce(F.col(f"r.v.{name}") > minimum, F.lit(False))
    return long.select(
        F.col("r.column_name").alias("column_name"),
        F.col("r.v.overall").alias("variance"),
        F.col("r.v.lost").alias("variance_event"),
        F.col("r.v.kept").alias("variance_no_event"),
        (enough("overall") & enough("lost") & enough("kept")).alias("keep"),
    )


def variance_filter(df: DataFrame, columns: Sequence[str], event: str = "event_lost", minimum: float = 1e-6) -> list[str]:
    """Covariates worth fitting (one small row per column comes to the driver)."""
    kept = {r.column_name for r in variance_report(df, columns, event, minimum).filter("keep").collect()}
    return [c for c in columns if c in kept]
