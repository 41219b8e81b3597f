"""Chi-square tails against closed forms, and contingency tables against a plain computation."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from hearthline.functions.gamma import chi_square_tail
from hearthline.operators.experiments import contingency_test


def tail(x, n):
    """By recurrence from erfc or exp, two degrees at a time."""
    y = x / 2
    q, a = (math.exp(-y), 1.0) if n % 2 == 0 else (math.erfc(math.sqrt(y)), 0.5)
    while a < n / 2:
        q, a = q + math.exp(a * math.log(y) - y - math.lgamma(a + 1)) if y else 1.0, a + 1
    return q


def test_chi_square_tail(spark):
    pairs = [(x, n) for n in [*range(1, 13), 30, 101, 600, 5000] for x in (0.0, 1e-6, 0.1, 0.9, 1.0, 2.5, 3.841458820694124, 7.0, n - 0.5, n * 1.0, n + 2.0, n * 1.3, n * 2.0, 60.0, 400.0)]
    df = spark.createDataFrame(pairs, "x double, n int").withColumn("p", chi_square_tail(F.col("x"), F.col("n")))
    for r in df.collect():
        assert abs(r.p - tail(r.x, r.n)) < 1e-9, (r, tail(r.x, r.n))
    odd = spark.createDataFrame([(None, 1), (1.0, 0), (-1.0, 2), (1.0, None)], "x double, n int")
    assert [r.p for r in odd.select(chi_square_tail(F.col("x"), F.col("n")).alias("p")).collect()] == [None] * 4
    assert abs(tail(3.841458820694124, 1) - 0.05) < 1e-12


def test_contingency(spark):
    rows = [("g", "abc"[k % 3], "xy"[k * k % 7 % 2]) for k in range(100)] + [("g", None, "x")] * 5 + [("one", "a", "x")] * 4
    got = {r.g: r for r in contingency_test(spark.createDataFrame(rows, "g string, r string, c string"), "r", "c", ["g"]).collect()}
    cells = Counter((r, c) for g, r, c in rows if g == "g")
    n = sum(cells.values())
    row, column = Counter(), Counter()
    for (r, c), k in cells.items():
        row[r] += k
        column[c] += k
    chi = sum((cells[r, c] - row[r] * column[c] / n) ** 2 / (row[r] * column[c] / n) for r in row for c in column)
    assert got["g"].n == n and got["g"].degrees == 3 and abs(got["g"].chi_square - chi) < 1e-9 and abs(got["g"].p_value - tail(chi, 3)) < 1e-9
    assert got["one"].chi_square is None and got["one"].p_value is None
