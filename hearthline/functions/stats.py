"""Exact order statistics and stable hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SKETCH_ACCURACY = 10_000


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the interpolated median of every column, NULL values ignored.

    The built-in median keeps every distinct value of a column in one buffer. Here a quantile sketch, whose
    rank error is bounded by 1/accuracy, gives an interval that must hold the middle. Values outside it are
    only counted, values inside collapse to one row each, and the running count goes over those few rows.
    """
    slack = 5.0 / SKETCH_ACCURACY
    pairs = [F.struct(F.lit(i).alias("c"), F.col(name).cast("double").alias("v")) for i, name in enumerate(columns)]
    long = df.select(F.inline(F.array(*pairs))).filter("v IS NOT NULL")
    probes = F.array(F.lit(0.5 - slack), F.lit(0.5 + slack))
    bounds = long.groupBy("c").agg(F.percentile_approx("v", probes, SKETCH_ACCURACY).alias("q"))
    # one bounds row per column, so the broadcast side is as small as the column list
    sided = long.join(F.broadcast(bounds), "c").selectExpr("c", "v", "CASE WHEN v < q[0] THEN -1 WHEN v > q[1] THEN 1 ELSE 0 END AS side")
    values = sided.selectExpr("c", "side", "IF(side = 0, v, NULL) AS v").groupBy("c", "side", "v").agg(F.count("*").alias("n"))
    each = W.partitionBy("c")
    ranked = values.select(
        "c", "v", "n", F.sum("n").over(each.orderBy("side", "v")).alias("upto"), F.sum("n").over(each).alias("total")
    )
    holds = lambda rank: f"upto - n < {rank} AND {rank} <= upto"
    middle = ranked.groupBy("c").agg(
        F.expr(
            f"(max(IF({holds('(total + 1) DIV 2')}, v, NULL)) + max(IF({holds('total DIV 2 + 1')}, v, NULL))) / 2"
        ).alias("median")
    )
    return middle.agg(*[F.max(F.when(F.col("c") == i, F.col("median"))).alias(name) for i, name in enumerate(columns)])


def hash_fraction(*parts: str | Column) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of an MD5: equal on every engine and every run."""
    text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
