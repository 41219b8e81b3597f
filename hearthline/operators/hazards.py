"""Proportional hazards: Cox regression by Newton steps on Efron's partial likelihood, and the baseline hazard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hearthline.operators.survival import TIMES

STEPS, TOLERANCE = 30, 1e-9
#: Durations are cut into so many ranges, each of which sums its risk sets by itself.
SEGMENTS = 64


@dataclass
class CoxModel:
    """``coefficients`` by feature (per unit), ``means`` they are centred on, the cumulative ``baseline`` hazard by duration at
    those means, and whether the fit ended (``fitted``)."""

    coefficients: dict[str, float]
    means: dict[str, float]
    baseline: DataFrame | None
    fitted: bool
    log_likelihood: float = float("nan")
    steps: int = field(default=0)


def fit_cox(df: DataFrame, features: Sequence[str], duration: str = "duration_days", event: str = "event_lost") -> CoxModel:
    """Rows with a null or without a duration teach nothing. Without events, with a covariate that does not vary or is a
    combination of others, or where a step fails to raise the likelihood within 30 steps (complete separation), ``fitted`` is false.

    A step is one job: rows are summed by duration, durations by range; a risk set is the sum of its own range from its duration
    on plus all later ranges, so no window holds all durations. Only the likelihood, its slope and curvature reach the driver.
    """
    rows = df.select(*[F.col(f).cast("double").alias(f"x{k}") for k, f in enumerate(features)], F.col(duration).cast("double").alias("t"), F.col(event).cast("double").alias("e"))
    rows = rows.dropna().where(reduce(lambda a, k: a & ~F.isnan(F.col(f"x{k}")), range(len(features)), ~F.isnan("t")))
    p = len(features)
    shape = rows.agg(F.sum("e").alias("events"), *[f(f"x{k}").alias(f"{f.__name__}{k}") for k in range(p) for f in (F.avg, F.stddev_pop)]).first()
    means = np.array([shape[f"avg{k}"] or 0.0 for k in range(p)])
    spread = np.array([shape[f"stddev_pop{k}"] or 0.0 for k in range(p)])
    by_name = lambda values: dict(zip(features, map(float, values)))
    none = CoxModel(by_name(np.zeros(p)), by_name(means), None, False)
    if not shape["events"] or (spread <= 1e-12 * np.maximum(1, np.abs(means))).any():
        return none
    scaled = rows.select("t", "e", *[((F.col(f"x{k}") - float(means[k])) / float(spread[k])).alias(f"x{k}") for k in range(p)])
    cuts = [float(x) for x in sorted(set(scaled.where("e > 0").approxQuantile("t", [k / SEGMENTS for k in range(1, SEGMENTS)], 0.005)))]
    beta, step = np.zeros(p), np.zeros(p)
    best: tuple[float, np.ndarray] | None = None
    for steps in range(1, STEPS + 1):
        value, slope, curve = _likelihood(scaled, beta, p, cuts)
        if best and not value >= best[0] - 1e-9 * abs(best[0]):
            step = step / 2  # overshot: half the way
            beta = best[1] + step
            continue
        best = (value, beta)
        try:
            step = np.linalg.solve(curve, slope)
        except np.linalg.LinAlgError:
            return none
        if not np.isfinite(step).all() or np.abs(beta).max() > 50 or np.linalg.cond(curve) > 1e12:
            return none
        if np.abs(step).max() < TOLERANCE:
            baseline = _risk_sets(scaled, beta, p, cuts)
            hazard = F.expr("aggregate(sequence(0, int(d) - 1), 0D, (a, l) -> a + 1 / (s - l / d * ds))")
            jumps = baseline.where("d > 0").select("segment", F.col("t").alias("duration"), hazard.alias("hazard"))
            return CoxModel(by_name(beta / spread), by_name(means), _running(jumps), True, value, steps)
        beta = beta + step
    return none


def _segment(cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c < F.col("t")))


def _risk_sets(rows: DataFrame, beta: np.ndarray, p: int, cuts: list[float]) -> DataFrame:
    """Per duration: number of events d, their sums (ds, d_k, d_k_j) and those of the risk set (s, s_k, s_k_j), each weighted by the
    relative hazard; x_k sums the covariates of the events."""
    score = reduce(lambda a, k: a + F.col(f"x{k}") * float(beta[k]), range(p), F.lit(0.0))
    rows = rows.withColumn("w", F.exp(score))
    terms = {"s": F.col("w")} | {f"s_{k}": F.col("w") * F.col(f"x{k}") for k in range(p)}
    terms |= {f"s_{k}_{j}": F.col("w") * F.col(f"x{k}") * F.col(f"x{j}") for k in range(p) for j in range(k, p)}
    hit = F.col("e") > 0
    own = rows.groupBy("t").agg(
        F.sum(hit.cast("double")).alias("d"), F.sum(F.when(hit, score).otherwise(0.0)).alias("score"),
        *[F.sum(F.when(hit, F.col(f"x{k}")).otherwise(0.0)).alias(f"x_{k}") for k in range(p)],
        *[F.sum(x).alias(n) for n, x in terms.items()], *[F.sum(F.when(hit, x).otherwise(0.0)).alias("d" + n) for n, x in terms.items()],
    ).withColumn("segment", _segment(cuts))
    later = own.groupBy("segment").agg(*[F.sum(n).alias(f"later_{n}") for n in terms])
    after = W.orderBy(F.desc("segment")).rowsBetween(W.unboundedPreceding, -1)  # a row a segment: 64 at most
    later = later.select("segment", *[F.coalesce(F.sum(f"later_{n}").over(after), F.lit(0.0)).alias(f"later_{n}") for n in terms])
    onward = W.partitionBy("segment").orderBy(F.desc("t"))
    joined = own.join(later, "segment")
    return joined.withColumns({n: F.sum(n).over(onward) + F.col(f"later_{n}") for n in terms}).drop(*[f"later_{n}" for n in terms])


def _likelihood(rows: DataFrame, beta: np.ndarray, p: int, cuts: list[float]) -> tuple[float, np.ndarray, np.ndarray]:
    """Efron's log likelihood, its slope and its negative curvature. Each of d tied events sees the risk set less a part of the
    ties."""
    sets = _risk_sets(rows, beta, p, cuts).where("d > 0")
    each = sets.withColumn("l", F.explode(F.sequence(F.lit(0), F.col("d").cast("int") - 1)))
    less = F.col("l") / F.col("d")
    at = lambda n: F.col(n) - less * F.col("d" + n)
    each = each.withColumn("all", at("s"))
    first = F.col("l") == 0
    mean = lambda k: at(f"s_{k}") / F.col("all")
    parts = [F.sum(F.when(first, F.col("score")).otherwise(0.0) - F.log("all")).alias("value")]
    parts += [F.sum(F.when(first, F.col(f"x_{k}")).otherwise(0.0) - mean(k)).alias(f"g{k}") for k in range(p)]
    parts += [F.sum(at(f"s_{k}_{j}") / F.col("all") - mean(k) * mean(j)).alias(f"h{k}_{j}") for k in range(p) for j in range(k, p)]
    row = each.agg(*parts).first()
    curve = np.array([[row[f"h{min(k, j)}_{max(k, j)}"] for j in range(p)] for k in range(p)], float)
    return float(row["value"]), np.array([row[f"g{k}"] for k in range(p)], float), curve


def _running(jumps: DataFrame) -> DataFrame:
    """Cumulative hazard by duration, ranges first."""
    before = W.orderBy("segment").rowsBetween(W.unboundedPreceding, -1)  # a row a segment: 64 at most
    sums = jumps.groupBy("segment").agg(F.sum("hazard").alias("h"))
    sums = sums.select("segment", F.coalesce(F.sum("h").over(before), F.lit(0.0)).alias("earlier"))
    own = W.partitionBy("segment").orderBy("duration")
    total = F.sum("hazard").over(own) + F.col("earlier")
    return jumps.join(sums, "segment").select("duration", "hazard", total.alias("cumulative_hazard"))


def cox_probs(model: CoxModel, df: DataFrame, times: Sequence[int] = TIMES) -> DataFrame:
    """Every row with ``hazard_ratio`` against the mean row, ``survival_prob_<t>d`` and ``survival_fitted``; NULL where a feature
    is null; 1 and false where the model could not be fitted."""
    names = [f"survival_prob_{t}d" for t in times]
    if not model.fitted or model.baseline is None:
        return df.withColumns({"hazard_ratio": F.lit(1.0)} | {n: F.lit(1.0) for n in names} | {"survival_fitted": F.lit(False)})
    reached = model.baseline.agg(*[F.coalesce(F.sum(F.when(F.col("duration") <= t, F.col("hazard"))), F.lit(0.0)).alias(f"t{t}") for t in times]).first()
    score = reduce(lambda a, b: a + b, [(F.col(f).cast("double") - m) * model.coefficients[f] for f, m in model.means.items()])
    ratio = F.exp(score)
    survive = {n: F.exp(-ratio * float(reached[f"t{t}"])) for n, t in zip(names, times)}
    return df.withColumns({"hazard_ratio": ratio} | survive | {"survival_fitted": F.lit(True)})
