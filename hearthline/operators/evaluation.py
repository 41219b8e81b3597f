"""How good a score is: exact area under the ROC curve, log loss and calibration, over any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: Score ranges that count their own ranks; their totals are added up over this many rows at most.
SEGMENTS = 64
LEAST = 1e-15


def _ranked(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: rows with label 1 (``pos``) and 0 (``neg``), and how many of both stand at lower scores
    (``pos_below``, ``neg_below``).

    Rows shrink to distinct scores first. Scores are cut into ranges by approximate quantiles; running counts are taken inside a
    range and over the ranges' totals, so no window holds all scores. Rows with a null score or label take no part.
    """
    rows = df.select(F.col(score).cast("double").alias("p"), F.col(label).cast("int").alias("y")).where("p IS NOT NULL AND NOT isnan(p) AND y IS NOT NULL")
    cuts = sorted(set(rows.approxQuantile("p", [k / SEGMENTS for k in range(1, SEGMENTS)], 0.005)))
    segment = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda c: c < F.col("p")))
    levels = rows.groupBy("p").agg(F.count_if(F.col("y") != 0).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).withColumn("segment", segment)
    earlier = W.orderBy("segment").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    totals = levels.groupBy("segment").agg(F.sum("pos").alias("sp"), F.sum("neg").alias("sn"))
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    totals = totals.select("segment", before("sp").alias("bp"), before("sn").alias("bn"))
    inside = W.partitionBy("segment").orderBy("p")
    below = lambda c, base: (F.sum(c).over(inside) - F.col(c) + F.col(base)).alias(f"{c}_below")
    return levels.join(totals, "segment").select("p", "pos", "neg", below("pos", "bp"), below("neg", "bn"))


def classifier_quality(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: ``n_rows``, ``n_positive``, ``auc`` (a tied pair counts half; NULL without both labels), ``log_loss`` (scores kept
    1e-15 off 0 and 1) and ``brier``. One job for the ranges and one for the sums; rows with a null take no part."""
    p = F.least(F.greatest(F.col("p"), F.lit(LEAST)), F.lit(1 - LEAST))
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    n = F.sum(F.col("pos") + F.col("neg"))
    return _ranked(df, score, label).agg(
        F.coalesce(n, F.lit(0)).alias("n_rows"), F.coalesce(F.sum("pos"), F.lit(0)).alias("n_positive"),
        F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"),
        F.try_divide(-F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p)), n).alias("log_loss"),
        F.try_divide(F.sum(F.col("pos") * (1 - F.col("p")) ** 2 + F.col("neg") * F.col("p") ** 2), n).alias("brier"),
    )


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """By quantile bin of the score, in order: rows, mean score and share of label 1. Equal scores share a bin, that of their first
    row, so a bin may stay empty."""
    levels = _ranked(df, score, label)
    total = levels.agg(F.sum(F.col("pos") + F.col("neg")).alias("total"))
    place = F.floor((F.col("pos_below") + F.col("neg_below")) * bins / F.col("total")).cast("int")
    n = F.sum(F.col("pos") + F.col("neg"))
    return levels.join(F.broadcast(total)).groupBy(place.alias("bin")).agg(  # one row
        n.alias("n_rows"), (F.sum(F.col("p") * (F.col("pos") + F.col("neg"))) / n).alias("mean_score"), (F.sum("pos") / n).alias("share_positive")
    )


def split_by_hash(df: DataFrame, key: str, held_out: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows by a hash of the key: the same key is always on the same side."""
    at = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(10_000)) >= int(round((1 - held_out) * 10_000))
    return df.where(~at), df.where(at)
