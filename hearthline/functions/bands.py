"""Label and score bands. The texts and limits are fixed values: results must equal them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday labels, Monday first.
WEEKDAY_LABELS = ["1. 月", "2. 火", "3. 水", "4. 木", "5. 金", "6. 土", "7. 日"]

# Fixed values: (days since the last session must exceed, score, label), then the rest.
CHURN_BANDS = [(30, 100, "離脱済み"), (14, 75, "高"), (7, 40, "要注意")]
CHURN_REST = (10, "活発")

# Concentration index below the limit -> status, then the rest.
HHI_BANDS = [(1500, "健全（分散）"), (2500, "要注意（中程度集中）")]
HHI_REST = "危険（高集中）"

# Quality score at or above the limit -> grade, then the rest.
QUALITY_GRADES = [(95, "優秀"), (90, "良好"), (80, "普通"), (70, "要改善")]
QUALITY_REST = "要緊急対応"

# Stage names -> rule-based win probability, then the rest.
STAGE_PROBABILITIES = [
    (("Closed Won", "Negotiation/Review"), 0.9),
    (("Proposal/Price Quote", "Value Proposition"), 0.7),
    (("Qualification", "Needs Analysis"), 0.5),
    (("Prospecting",), 0.3),
]
STAGE_REST = 0.2

# Probability at or above the limit -> category, then the rest.
PROBABILITY_BANDS = [(0.9, "Very High (90%+)"), (0.7, "High (70-90%)"), (0.5, "Medium (50-70%)"), (0.3, "Low (30-50%)")]
PROBABILITY_REST = "Very Low (<30%)"

# Risk and priority levels.
RISK_BANDS = [(0.7, "Critical"), (0.4, "High")]
RISK_REST = "Medium"
PRIORITY_BANDS = [(100, "Critical"), (50, "High"), (20, "Medium")]
PRIORITY_REST = "Low"

# Activity count bins (upper edge, label), then the rest.
ACTIVITY_BINS = [(0, "0"), (3, "1-3"), (10, "4-10")]
ACTIVITY_REST = "11+"


def _chain(cases: list[tuple[Column, object]], rest: object) -> Column:
    out = None
    for cond, value in cases:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(rest if isinstance(rest, Column) else F.lit(rest))


def at_least(c: Column, bands: list[tuple[float, str]], rest: object) -> Column:
    return _chain([(c >= limit, label) for limit, label in bands], rest)


def weekday_label(c: Column) -> Column:
    return _chain([(c == i, label) for i, label in enumerate(WEEKDAY_LABELS)], c.cast("string"))


def churn_score(days: Column) -> Column:
    return _chain([(days > d, s) for d, s, _ in CHURN_BANDS], CHURN_REST[0])


def churn_level(days: Column) -> Column:
    return _chain([(days > d, label) for d, _, label in CHURN_BANDS], CHURN_REST[1])


def hhi_status(hhi: Column) -> Column:
    return _chain([(hhi < limit, label) for limit, label in HHI_BANDS], HHI_REST)


def traffic_light(growth_pct: Column) -> Column:
    """RED below -15 %, YELLOW below 0 %, GREEN otherwise and where growth is unknown."""
    return _chain([(growth_pct.isNull(), "GREEN"), (growth_pct < -15, "RED"), (growth_pct < 0, "YELLOW")], "GREEN")


def quality_grade(rate: Column) -> Column:
    return at_least(rate, QUALITY_GRADES, QUALITY_REST)


def win_probability_rule(stage: Column) -> Column:
    return _chain([(stage.isin(*names), p) for names, p in STAGE_PROBABILITIES], STAGE_REST)


def probability_category(p: Column) -> Column:
    return at_least(p, PROBABILITY_BANDS, PROBABILITY_REST)


def risk_level(score: Column) -> Column:
    return at_least(score, RISK_BANDS, RISK_REST)


def priority_level(score: Column) -> Column:
    return at_least(score, PRIORITY_BANDS, PRIORITY_REST)


def activity_bin(count: Column) -> Column:
    return _chain([(count <= edge, label) for edge, label in ACTIVITY_BINS], ACTIVITY_REST)
