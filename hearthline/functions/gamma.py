"""Tail probabilities of the chi-square distribution as built-in expressions."""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column, functions as F


def log_gamma_half(n: Column) -> Column:
    """ln gamma(n / 2) of a whole n of 1 or more: a product of whole or half numbers."""
    steps = F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int"))
    even = n % 2 == 0
    term = lambda k: F.when(even, F.log(F.greatest(k, F.lit(1)).cast("double"))).otherwise(F.log(k - 0.5))
    total = F.aggregate(steps, F.lit(0.0), lambda a, k: a + F.when(k > 0, term(k)).otherwise(0.0))
    return F.when(even, total).otherwise(total + log(pi) / 2)


def chi_square_tail(statistic: Column, degrees: Column) -> Column:
    """The probability of at least ``statistic`` with so many ``degrees`` of freedom (whole, 1 or more), to about 1e-12; NULL for a
    null, a negative statistic or no degree.

    The regularised incomplete gamma function, summed as a series below its turn and as a continued fraction above, each as a fold
    over a number of terms that grows with the square root of the degrees.
    """
    a, x, n = degrees.cast("double") / 2, statistic.cast("double") / 2, degrees.cast("int")
    terms = F.sequence(F.lit(1), (F.lit(120) + 16 * F.sqrt(a)).cast("int"))
    scale = F.exp(-x + a * F.log(x) - log_gamma_half(n))

    def grow(s: Column, k: Column) -> Column:
        term = s["t"] * x / (a + k)
        return F.struct(term.alias("t"), (s["s"] + term).alias("s"))

    series = F.aggregate(terms, F.struct((1 / a).alias("t"), (1 / a).alias("s")), grow, lambda s: 1 - scale * s["s"])

    def descend(s: Column, k: Column) -> Column:
        part, b = -k * (k - a), x + 1 - a + 2 * k
        c, d = b + part / s["c"], 1 / (part * s["d"] + b)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    first = 1 / (x + 1 - a)
    fraction = F.aggregate(terms, F.struct(F.lit(1e300).alias("c"), first.alias("d"), first.alias("h")), descend, lambda s: scale * s["h"])
    inside = F.when(x == 0, 1.0).when(x < a + 1, series).otherwise(fraction)
    return F.when((x >= 0) & (n >= 1), F.greatest(F.lit(0.0), F.least(F.lit(1.0), inside)))
