from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from hearthline.functions.stats import exact_medians, hash_fraction
from hearthline.operators import experiments, modelling, prompts, recommend, revenue, survival
from hearthline.plans.registry import Inputs
from hearthline.plans import sales

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 400 + [1.0], [float(i * i % 97) for i in range(1001)], [1e300, -1e300, 0.0, 1.0], [None, 2.0, 4.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v, -v if v is not None else None) for v in values], "a double, b double")
    known = [v for v in values if v is not None]
    assert tuple(exact_medians(df, ["a", "b"]).first()) == (statistics.median(known), statistics.median([-v for v in known]))


def test_exact_median_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([], "a double"), ["a"]).first().a is None


def test_hash_fraction_is_uniform_and_stable(spark):
    df = spark.range(4000).select(hash_fraction("t", F.col("id").cast("string")).alias("x"))
    assert abs(df.filter("x < 0.3").count() / 4000 - 0.3) < 0.03
    assert df.filter("x < 0 OR x >= 1").count() == 0


def test_assignment(spark):
    units = spark.range(3000).toDF("account_id")
    share = lambda test, ratio: experiments.ab_assign(units, test, "2026-01-01", ratio).filter("test_group = 'treatment'").count() / 3000
    assert abs(share("t1", 0.5) - 0.5) < 0.04 and abs(share("t1", 0.2) - 0.2) < 0.04
    one = experiments.ab_assign(units, "t1", "2026-01-01").select("account_id", "test_group")
    assert one.exceptAll(experiments.ab_assign(units.repartition(7), "t1", "2026-01-01").select("account_id", "test_group")).count() == 0


def test_attribution_window(spark, ntz):
    tests = ntz([(1, "2026-01-10"), (2, "2026-01-10"), (3, "2026-01-10"), (1, "2026-05-01")], "account_id int, test_start_date string", dates=("test_start_date",))
    opp = ntz(
        [(1, "2026-01-09", 10, 5.0, True), (1, "2026-04-10", 11, 6.0, True), (1, "2026-01-10", 12, 7.0, False), (2, "2026-04-11", 13, 8.0, True), (3, "2026-02-02", 15, 1.0, True), (3, "2026-02-02", 14, 2.0, True)],
        "account_id int, close_date string, opportunity_id int, amount double, is_won boolean", dates=("close_date",))
    got = {(r.account_id, str(r.test_start_date)): r.opportunity_id for r in experiments.ab_attribute(tests, opp, 90).collect()}
    assert got == {(1, "2026-01-10"): 11, (2, "2026-01-10"): None, (3, "2026-01-10"): 14, (1, "2026-05-01"): None}


def test_lift_with_empty_control(spark):
    df = spark.createDataFrame([("t", "treatment", True, 10.0)], "test_id string, test_group string, is_purchased boolean, purchase_amount double")
    row = experiments.ab_summary(df).first()
    assert row.treatment_purchase_rate == 1.0 and row.control_purchase_rate is None and row.purchase_rate_lift_pct is None and row.revenue_lift == 10.0


def test_hybrid_risk_without_survival(spark):
    df = spark.createDataFrame([(0.5, None), (0.5, 1.0), (0.5, 0.0)], "churn_risk_score double, survival_prob_30d double")
    assert [round(r.hybrid_risk_score, 6) for r in revenue.hybrid_risk(df).collect()] == [0.5, 0.3, 0.7]


def test_sales_priority_ignores_missing_crosssell(spark):
    rec = spark.createDataFrame([("a", 0.4), ("a", 0.9), ("b", 0.1)], "account_id string, purchase_score double")
    got = {r.account_id: (r.upsell_probability, r.crosssell_probability, r.priority_level) for r in revenue.priority_customers(rec).collect()}
    assert got == {"a": (0.9, None, "High"), "b": (0.1, None, "Low")}


def test_survival_probabilities_fall(spark):
    c = Inputs(spark, SF)
    df = sales._features(c)
    rows = survival.survival_probs(df.filter("is_closed"), df.filter("NOT is_closed"), sales.COVARIATES[:2]).collect()
    assert rows and all(1 >= r.survival_prob_30d >= r.survival_prob_60d >= r.survival_prob_90d >= 0 for r in rows)


def test_survival_fallback(spark):
    df = spark.createDataFrame([(1.0, 0, 0)], "x double, duration_days int, event_lost int")
    row = survival.survival_probs(df, df, ["x"]).first()  # no positive duration: nothing to fit
    assert (row.survival_prob_30d, row.survival_prob_90d) == (1.0, 1.0)


def test_kaplan_meier_ties_and_extinction(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1)], "duration_days int, event_lost int")
    got = [(r.duration_days, r.at_risk, r.events, round(r.survival, 6)) for r in survival.kaplan_meier(df).orderBy("duration_days").collect()]
    assert got == [(1, 4, 1, 0.75), (2, 2, 2, 0.0)]


def test_variance_filter(spark):
    df = spark.range(100).selectExpr("id AS good", "1 AS flat", "IF(id % 2 = 1, id, 7) AS flat_when_lost", "int(id % 2 = 0) AS event_lost")
    assert survival.variance_filter(df, ["good", "flat", "flat_when_lost"]) == ["good"]


@pytest.mark.parametrize("kind", ["logistic", "gbt"])
def test_classifier_separates(spark, kind):
    df = spark.range(200).selectExpr("double(id) AS x", "double(id % 7) AS noise", "int(id >= 100) AS label")
    model = modelling.fit_classifier(df, "label", ["x", "noise"], kind=kind, maxIter=5)
    scored = modelling.score(model, df)
    assert scored.columns == ["x", "noise", "label", "score"]
    low, high = (scored.filter(f"label = {v}").agg(F.avg("score")).first()[0] for v in (0, 1))
    assert high - low > 0.5
    raw = model.transform(df).select(modelling.raw_score().alias("r"), "label")
    assert raw.filter("label = 1").agg(F.avg("r")).first()[0] > raw.filter("label = 0").agg(F.avg("r")).first()[0]


def test_factors_from_a_model(spark):
    df = spark.range(200).selectExpr("double(id) AS x", "double(id % 7) AS noise", "int(id >= 100) AS label")
    columns = ["x", "noise"]
    model = modelling.fit_classifier(df, "label", columns)
    out = modelling.top_factors(df, modelling.linear_terms(model, columns), modelling.column_means(df, columns), k=3)
    row = out.filter("x = 0").first()
    assert (row.risk_factor_1, row.risk_factor_2, row.risk_factor_3) == ("x", "noise", None)


def brute_force(bought, segment, n):
    by_segment = {}
    for a, p in bought:
        by_segment.setdefault(segment[a], {}).setdefault(p, set()).add(a)
    out = []
    for a in {a for a, _ in bought}:
        buyers = len({x for x, _ in bought if segment[x] == segment[a]})
        ranked = sorted((-len(s) / buyers, p) for p, s in by_segment[segment[a]].items() if (a, p) not in bought)
        out += [(a, p, i + 1) for i, (_, p) in enumerate(ranked[:n])]
    return sorted(out)


def test_recommend_equals_brute_force(spark):
    bought = {(a, (a * a * 31 + i * 17) % 53 * 300) for a in range(40) for i in range(a % 9 + 1)} | {(1, p * 300) for p in range(53)}
    segment = {a: "AB"[a % 2] for a in range(40)}
    df = spark.createDataFrame(sorted(bought), "account_id int, product_id int")
    accounts = spark.createDataFrame(list(segment.items()), "account_id int, segment string")
    got = sorted((r.account_id, r.product_id, r.recommendation_rank) for r in recommend.recommend(df, accounts, 4).collect())
    assert got == brute_force(bought, segment, 4)


@pytest.mark.parametrize("name", ["r17_recommend", "r17_recommend_cf"])
def test_recommendations_read_written_purchases(spark, name):
    """Orders and lines are joined once, and an account's own products are taken from its places without a join of every asked one."""
    from hearthline.plans import registry, sales  # noqa: F401  (importing registers the queries)

    plan = registry.run(name, spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "LeftAnti" not in plan


def test_recommend_with_null_products(spark):
    rows = [(1, None), (1, 5), (2, None), (2, 5), (2, 6), (3, 7), (3, 8), (3, 9), (4, None), (4, 9)]
    df = spark.createDataFrame(rows, "account_id int, product_id int")
    accounts = spark.createDataFrame([(a, "S") for a in range(1, 5)], "account_id int, segment string")
    got = sorted((r.account_id, r.product_id, r.recommendation_rank) for r in recommend.recommend(df, accounts, 2).collect())
    assert got == sorted([(1, 9, 1), (1, 6, 2), (2, 9, 1), (2, 7, 2), (3, 5, 1), (3, 6, 2), (4, 5, 1), (4, 6, 2)])


def test_cf_scores(spark):
    rows = [(a, p, 5.0) for a in range(12) for p in range(6) if (a + p) % 3]
    bought = spark.createDataFrame(rows, "account_id int, product_id int, quantity double")
    accounts = spark.range(12).selectExpr("int(id) AS account_id", "'S' AS segment")
    out = recommend.with_cf_score(recommend.recommend(bought, accounts, 3), recommend.fit_cf(bought, rank=3))
    assert out.filter("cf_score IS NULL OR purchase_score IS NULL").count() == 0
    assert out.groupBy("account_id").agg(F.max("recommendation_rank").alias("m")).filter("m > 3").count() == 0


REQUEST = "tone string, length string, formality string, emoji_density string, structure string, cta_strength string, user_request string, context_facts string"


def test_prompt_order_and_optional_context(spark):
    rows = [("calm", "short", "casual", "なし", "list", "soft", "　 ask \n", " facts \n"), ("calm", "short", "casual", "なし", "list", "soft", "ask", "  ")]
    texts = [r.full_prompt for r in prompts.build_prompts(spark.createDataFrame(rows, REQUEST), "HEAD \n[Single-parameter Examples]\nex\n[Output instruction]\n go \n").collect()]
    marks = ["HEAD", "[Hyperparameter Definitions", "Emoji density: なし", "[Single-parameter Examples", "[Context facts]", "[User request", "[Output instruction]"]
    places = [texts[0].index(m) for m in marks]
    # the precedence line mentions the request section before the section itself
    places[5] = texts[0].rindex("[User request")
    assert places == sorted(places)
    assert "\n\n[Context facts]\nfacts\n\n[User request (natural language)]\nask\n\n[Output instruction]go" in texts[0]
    assert "[Context facts]" not in texts[1]


def test_template_needs_its_markers():
    with pytest.raises(ValueError):
        prompts.Template.parse("no markers")


def test_batch_errors_stay_on_their_row(spark):
    def model(texts):
        if any(t == "bad" for t in texts):
            raise RuntimeError("refused")
        return ['{"result": "%s"}' % t.upper() for t in texts]

    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "full_prompt string").coalesce(1)
    out = prompts.parse_response(prompts.batch_infer(df, model)).orderBy("full_prompt").collect()
    assert [(r.text, r.error) for r in out] == [("A", None), ("B", None), (None, "RuntimeError: refused")]


def test_parse_response(spark):
    df = spark.createDataFrame([('{"result": "x"}',), ('{"errorMessage": "no"}',), ("plain text",), ('{"result": "y", "errorMessage": ""}',)], "response string")
    assert [(r.text, r.error_message) for r in prompts.parse_response(df).collect()] == [("x", None), (None, "no"), ("plain text", None), ("y", None)]
