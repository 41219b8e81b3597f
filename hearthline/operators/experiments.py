"""A/B tests: assignment, outcome attribution, lift and significance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hearthline.functions.casts import date_lit
from hearthline.functions.gamma import chi_square_tail
from hearthline.functions.stats import hash_fraction

TREATMENT, CONTROL = "treatment", "control"


def ab_assign(units: DataFrame, test_id: str, test_start_date: str | date, ratio: float = 0.5, unit: Sequence[str] = ("account_id",)) -> DataFrame:
    """Group of every unit from a hash seeded by the test id: the same on every run, no shuffle, no state."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in unit])
    draw = hash_fraction(test_id, "|", key)
    return units.withColumns(
        {
            "test_id": F.lit(test_id),
            "test_start_date": date_lit(test_start_date),
            "test_group": F.when(draw < ratio, TREATMENT).otherwise(CONTROL),
        }
    )


def first_in_window(starts: DataFrame, outcomes: DataFrame, key: str, start: str, when: str, days: int, keep: Sequence[str]) -> DataFrame:
    """For every distinct (key, start): the earliest outcome dated in [start, start + days].

    Outcomes shrink to one row per key and date, starts to one row per key and start. Dates fall into cells as
    long as the window, so a window touches two cells at most: the join is an equality on key and cell, and
    even a key that owns a large share of the rows meets only the dates near each start.
    """
    width = days + 1
    cell = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / width)
    daily = outcomes.groupBy(key, F.col(when).alias("_when")).agg(
        F.min(F.struct(*keep)).alias("_row")
    ).withColumn("_cell", cell(F.col("_when")))
    wanted = starts.select(key, start).distinct().withColumn(
        "_cell", F.explode(F.array(cell(F.col(start)), cell(F.col(start)) + 1))
    )
    in_window = (F.col("_when") >= F.col(start)) & (F.col("_when") <= F.date_add(F.col(start), days))
    return (
        wanted.join(daily, [key, "_cell"])
        .filter(in_window)
        .groupBy(key, start)
        .agg(F.min(F.struct("_when", "_row")).alias("_first"))
        .select(key, start, F.col("_first._when").alias(when), *[F.col(f"_first._row.{c}").alias(c) for c in keep])
    )


def ab_attribute(tests: DataFrame, opp: DataFrame, lookback_days: int = 90) -> DataFrame:
    """Each test row with the earliest won opportunity of its account closed within the window, if any."""
    won = opp.filter(F.col("is_won")).select("account_id", "close_date", "opportunity_id", "amount")
    hits = first_in_window(tests, won, "account_id", "test_start_date", "close_date", lookback_days, ["opportunity_id", "amount"])
    hits = hits.select(
        "account_id",
        "test_start_date",
        F.col("close_date").alias("purchase_date"),
        F.col("amount").cast("decimal(18,2)").alias("purchase_amount"),
        "opportunity_id",
    )
    joined = tests.join(hits, ["account_id", "test_start_date"], "left")
    return joined.withColumn("is_purchased", F.col("opportunity_id").isNotNull())


def _counts() -> list[Column]:
    group, bought = F.col("test_group"), F.coalesce("is_purchased", F.lit(False))
    # money is summed as decimal: exact, and the same however the rows are partitioned
    revenue = lambda g: F.coalesce(F.sum(F.when((group == g) & bought, F.col("purchase_amount").cast("decimal(18,2)"))), F.lit(0)).cast("double")
    return [
        *[F.count_if(group == g).alias(f"{g}_count") for g in (TREATMENT, CONTROL)],
        *[F.count_if((group == g) & bought).alias(f"{g}_purchases") for g in (TREATMENT, CONTROL)],
        *[revenue(g).alias(f"{g}_revenue") for g in (TREATMENT, CONTROL)],
    ]


def ab_by(results: DataFrame, *dims: str | Column) -> DataFrame:
    """Counts, purchase rates and lifts of both groups on one row per combination of ``dims``. Rates of an
    empty group and relative lifts over a zero control are NULL."""
    rate = lambda g: F.try_divide(f"{g}_purchases", f"{g}_count")
    t, c = F.col("treatment_purchase_rate"), F.col("control_purchase_rate")
    tr, cr = F.col("treatment_revenue"), F.col("control_revenue")
    return (
        results.groupBy(*dims)
        .agg(*_counts())
        .withColumns({"treatment_purchase_rate": rate(TREATMENT), "control_purchase_rate": rate(CONTROL)})
        .withColumns(
            {
                "purchase_rate_lift": t - c,
                "purchase_rate_lift_pct": (F.try_divide(t, c) - 1) * 100,
                "revenue_lift": tr - cr,
                "revenue_lift_pct": (F.try_divide(tr, cr) - 1) * 100,
            }
        )
    )


def ab_summary(results: DataFrame) -> DataFrame:
    return ab_by(results, "test_id")


def score_band(score: str = "purchase_score") -> Column:
    """Lower edge of the tenth a score lies in."""
    return (F.floor(F.col(score) * 10) / 10).alias("score_band")


def ab_chi_square(results: DataFrame) -> DataFrame:
    """The 2 x 2 table of every test and its chi-square statistic, NULL where a margin is empty."""
    n = lambda c: F.col(c).cast("double")
    a, c = n("treatment_purchases"), n("control_purchases")
    b, d = n("treatment_count") - a, n("control_count") - c
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    table = results.groupBy("test_id").agg(*_counts()).select(
        "test_id",
        "treatment_purchases",
        (F.col("treatment_count") - F.col("treatment_purchases")).alias("treatment_no_purchases"),
        "control_purchases",
        (F.col("control_count") - F.col("control_purchases")).alias("control_no_purchases"),
        F.try_divide((a + b + c + d) * F.pow(a * d - b * c, 2), margins).alias("chi_square"),
    )
    return table


def ab_significance(results: DataFrame) -> DataFrame:
    """The chi-square table of every test with ``p_value``, the probability of so large a statistic without any effect."""
    table = ab_chi_square(results)
    return table.withColumn("p_value", chi_square_tail(F.col("chi_square"), F.lit(1)))


def contingency_test(df: DataFrame, rows: str, columns: str, group: Sequence[str] = ()) -> DataFrame:
    """Chi-square test of independence of two columns, by ``group``: ``n``, ``degrees``, ``chi_square`` and ``p_value``. Null is a
    value like any other; with one row or column value there is no degree of freedom and both figures are NULL.

    Input rows shrink to cells first; the statistic is n x (sum of cell² / (row x column) - 1), so empty cells need no row.
    """
    keys = [F.col(g).alias(f"g{k}") for k, g in enumerate(group)]
    names = [f"g{k}" for k in range(len(group))]
    cells = df.select(*keys, F.col(rows).alias("r"), F.col(columns).alias("c")).groupBy(*names, "r", "c").agg(F.count("*").alias("n"))
    by = lambda *more: W.partitionBy(*names, *more)
    sums = cells.withColumns({"row": F.sum("n").over(by("r")), "column": F.sum("n").over(by("c"))})
    tested = sums.groupBy(*names).agg(
        F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n") / F.col("row") / F.col("column")).alias("_parts"),
        ((F.count_distinct(F.struct("r")) - 1) * (F.count_distinct(F.struct("c")) - 1)).alias("degrees"),
    )
    statistic = F.when(F.col("degrees") > 0, F.greatest(F.lit(0.0), F.col("n") * (F.col("_parts") - 1)))
    out = tested.withColumn("chi_square", statistic).withColumn("p_value", chi_square_tail(F.col("chi_square"), F.col("degrees")))
    return out.select(*[F.col(f"g{k}").alias(g) for k, g in enumerate(group)], "n", "degrees", "chi_square", "p_value")
