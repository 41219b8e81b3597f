"""Registered sales queries: revenue, recommendations, experiments, survival and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hearthline.functions.bands import activity_bin, win_probability_rule
from hearthline.functions.clock import quarter_start
from hearthline.operators import attribution, evaluation, experiments, hazards, modelling, recommend, revenue, survival
from hearthline.operators.copurchase import copurchase
from hearthline.plans.fixtures import AS_OF, SALES_AS_OF
from hearthline.plans.registry import Inputs, query
from hearthline.sources.staging import stage

CASES = """sum(amount * p) AS expected_revenue, sum(CASE WHEN p >= 0.3 THEN amount ELSE 0 END) AS best_case_revenue,
  sum(CASE WHEN p >= 0.6 THEN amount ELSE 0 END) AS moderate_case_revenue, sum(CASE WHEN p >= 0.9 THEN amount ELSE 0 END) AS worst_case_revenue"""
CASE_NAMES = "expected_revenue best_case_revenue moderate_case_revenue worst_case_revenue"


@query("r1_opportunity_features", f"""SELECT opportunity_id, coalesce(n, 0) AS stage_change_count, v AS amount_variance, coalesce(c, 0) AS history_record_count,
  datediff('day', created_date, DATE '{SALES_AS_OF}') AS days_since_created, datediff('day', DATE '{SALES_AS_OF}', close_date) AS days_until_close,
  datediff('day', CAST(last AS DATE), DATE '{SALES_AS_OF}') AS stage_duration_days FROM fx_opportunity LEFT JOIN (
  SELECT opportunity_id, count(DISTINCT stage_name) AS n, (max(amount) - min(amount)) / nullif(max(amount), 0) AS v, count(*) AS c, max(changed_at) AS last
  FROM fx_history GROUP BY 1) USING (opportunity_id)""", floats="amount_variance")
def _(c: Inputs) -> DataFrame:
    return revenue.opportunity_features(c.opportunities, c.opportunity_history, SALES_AS_OF)


RECENT = f"activity_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}'"


@query("r2_activity_features", f"""SELECT *, activity_count_last_30days / 30.0::DOUBLE * 7 AS weekly_activity_frequency FROM (SELECT account_id,
  datediff('day', max(activity_date), DATE '{AS_OF}') AS days_since_last_activity, count(*) FILTER ({RECENT}) AS activity_count_last_30days,
  count(*) FILTER ({RECENT} AND activity_type = 'task') AS task_count_last_30days, count(*) FILTER ({RECENT} AND activity_type = 'event') AS event_count_last_30days,
  count(*) FILTER ({RECENT} AND activity_type = 'meeting') AS meeting_count_last_30days, count(*) FILTER (activity_type = 'task' AND is_open) AS open_task_count,
  count(*) FILTER (activity_type = 'task' AND is_open AND activity_date < DATE '{AS_OF}') AS overdue_task_count FROM fx_activity GROUP BY 1)""",
       floats="weekly_activity_frequency")
def _(c: Inputs) -> DataFrame:
    return revenue.activity_features(c.activities, AS_OF)


@query("r3_win_probability_rule", """SELECT o_orderkey AS opportunity_id, CASE o_orderpriority WHEN '1-URGENT' THEN 0.9 WHEN '2-HIGH' THEN 0.7 WHEN '3-MEDIUM' THEN 0.5
  WHEN '4-NOT SPECIFIED' THEN 0.3 ELSE 0.2 END AS win_probability FROM orders""", floats="win_probability")
def _(c: Inputs) -> DataFrame:
    stages = {"1-URGENT": "Closed Won", "2-HIGH": "Value Proposition", "3-MEDIUM": "Needs Analysis", "4-NOT SPECIFIED": "Prospecting"}
    named = F.coalesce(*[F.when(F.col("o_orderpriority") == k, v) for k, v in stages.items()], F.lit("Other"))
    return c.table("orders").select(F.col("o_orderkey").alias("opportunity_id"), win_probability_rule(named).alias("win_probability"))


@query("r4_win_outputs", """SELECT opportunity_id, p AS win_probability, CAST(created_date + to_days(CAST(floor(a + 0.5) AS INT)) AS DATE) AS predicted_close_date,
  p - 0.1 AS confidence_interval_lower, p + 0.1 AS confidence_interval_upper, CASE WHEN p >= 0.9 THEN 'Very High (90%+)' WHEN p >= 0.7 THEN 'High (70-90%)'
  WHEN p >= 0.5 THEN 'Medium (50-70%)' WHEN p >= 0.3 THEN 'Low (30-50%)' ELSE 'Very Low (<30%)' END AS probability_category
  FROM (SELECT o.*, win_probability AS p FROM fx_opportunity o JOIN fx_prediction USING (opportunity_id)),
  (SELECT avg(datediff('day', created_date, close_date)) AS a FROM fx_opportunity WHERE is_closed AND is_won)""",
       floats="win_probability confidence_interval_lower confidence_interval_upper")
def _(c: Inputs) -> DataFrame:
    scored = c.opportunities.join(c.predictions.select("opportunity_id", "win_probability"), "opportunity_id")
    return revenue.win_outputs(scored, c.opportunities)


@query("r5_risk_level", """SELECT opportunity_id, churn_risk_score, churn_risk_score * 100 AS risk_score,
  CASE WHEN churn_risk_score >= 0.7 THEN 'Critical' WHEN churn_risk_score >= 0.4 THEN 'High' ELSE 'Medium' END AS risk_level FROM fx_churn""",
       floats="churn_risk_score risk_score")
def _(c: Inputs) -> DataFrame:
    return revenue.with_risk(c.churn)


@query("r6_hybrid_risk", """SELECT opportunity_id, churn_risk_score AS c, s, CASE WHEN s IS NULL THEN churn_risk_score ELSE churn_risk_score * 0.6::DOUBLE + (1.0::DOUBLE - s) * 0.4::DOUBLE END AS hybrid_risk_score
  FROM (SELECT *, CASE WHEN opportunity_id % 4 > 0 THEN CAST(opportunity_id % 50 AS DOUBLE) / 50 END AS s FROM fx_churn)""", floats="c s hybrid_risk_score")
def _(c: Inputs) -> DataFrame:
    k = F.col("opportunity_id")
    rows = c.churn.select("opportunity_id", F.col("churn_risk_score").alias("c"), F.when(k % 4 > 0, (k % 50).cast("double") / 50).alias("s"))
    return revenue.hybrid_risk(rows, "c", "s")


@query("r7_risk_priority", """SELECT opportunity_id, priority_score, CASE WHEN priority_score >= 100 THEN 'Critical' WHEN priority_score >= 50 THEN 'High'
  WHEN priority_score >= 20 THEN 'Medium' ELSE 'Low' END AS priority_level FROM scored_open""", floats="priority_score:8")
def _(c: Inputs) -> DataFrame:
    rows = c.opportunities.filter(~F.col("is_closed")).join(c.churn, "opportunity_id")
    return revenue.risk_priority(rows).select("opportunity_id", "priority_score", "priority_level")


ACTUAL_SQL = f"""SELECT CAST(date_trunc('month', close_date) AS DATE) AS period, sum(amount) AS actual_revenue, count(*) AS actual_won_count FROM fx_opportunity
  WHERE is_closed AND is_won AND close_date >= DATE '{SALES_AS_OF}' - INTERVAL 6 MONTH GROUP BY 1"""
FORECAST_SQL = f"SELECT CAST(date_trunc('month', due) AS DATE) AS period, {CASES}, count(*) AS opportunity_count FROM open_due GROUP BY 1"


@query("r8_monthly_actual", ACTUAL_SQL, floats="actual_revenue", digits=2)
def _(c: Inputs) -> DataFrame:
    return revenue.monthly_actual(c.opportunities, SALES_AS_OF)


@query("r9_monthly_forecast", FORECAST_SQL, floats=CASE_NAMES, digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.monthly_forecast(c.opportunities, c.predictions, SALES_AS_OF)


BAND = lambda name, cond: f"sum(CASE WHEN {cond} THEN amount ELSE 0 END) AS {name}"
QUARTER_SQL = f"""SELECT CAST(date_trunc('quarter', close_date) AS DATE) AS period, {BAND('actual_revenue', 'is_closed AND is_won')},
  sum(CASE WHEN is_closed AND is_won THEN amount WHEN NOT is_closed THEN amount * p ELSE 0 END) AS expected_revenue,
  {BAND('best_case_revenue', 'p >= 0.3')}, {BAND('worst_case_revenue', 'p >= 0.9')}, {BAND('prob_90_plus', 'p >= 0.9')},
  {BAND('prob_70_90', 'p >= 0.7 AND p < 0.9')}, {BAND('prob_50_70', 'p >= 0.5 AND p < 0.7')}, {BAND('prob_30_50', 'p >= 0.3 AND p < 0.5')}
  FROM (SELECT o.*, win_probability AS p FROM fx_opportunity o LEFT JOIN fx_prediction USING (opportunity_id)) GROUP BY 1"""
QUARTER_NAMES = "actual_revenue expected_revenue best_case_revenue worst_case_revenue prob_90_plus prob_70_90 prob_50_70 prob_30_50"


@query("r10_quarterly_forecast", QUARTER_SQL, floats=QUARTER_NAMES, digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.quarterly_forecast(c.opportunities, c.predictions)


@query("r11_annual_forecast", f"""SELECT fiscal_year, h1_actual, e AS full_year_expected, b AS full_year_best_case, w AS full_year_worst_case, period_type, target_revenue,
  e / nullif(target_revenue, 0) * 100 AS achievement_rate, e - target_revenue AS variance_to_target FROM (
  SELECT fiscal_year, coalesce(h1, 0) AS h1_actual, CASE WHEN expected_revenue IS NOT NULL THEN coalesce(h1, 0) + expected_revenue ELSE total END AS e,
    CASE WHEN expected_revenue IS NOT NULL THEN coalesce(h1, 0) + best_case_revenue ELSE total END AS b,
    CASE WHEN expected_revenue IS NOT NULL THEN coalesce(h1, 0) + worst_case_revenue ELSE total END AS w,
    CASE WHEN expected_revenue IS NOT NULL THEN 'forecast' ELSE 'actual' END AS period_type
  FROM (SELECT year(close_date) AS fiscal_year, sum(amount) AS total, sum(CASE WHEN month(close_date) <= 6 THEN amount ELSE 0 END) AS h1
    FROM fx_opportunity WHERE is_closed AND is_won GROUP BY 1)
  FULL JOIN (SELECT year(due) AS fiscal_year, {CASES} FROM open_due WHERE year(due) = 2001 AND month(due) > 6 GROUP BY 1) USING (fiscal_year))
  LEFT JOIN (SELECT year(period) AS fiscal_year, sum(target_revenue) AS target_revenue FROM fx_target GROUP BY 1) USING (fiscal_year)""",
       floats="h1_actual full_year_expected full_year_best_case full_year_worst_case target_revenue achievement_rate variance_to_target", ints="fiscal_year", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.annual_forecast(c.opportunities, c.predictions, c.targets, SALES_AS_OF)


@query("r12_monthly_vs_target", f"""SELECT *, v / nullif(target_revenue, 0) * 100 AS achievement_rate, v - target_revenue AS variance_to_target,
  (v - target_revenue) / nullif(target_revenue, 0) * 100 AS variance_to_target_pct FROM (SELECT *, coalesce(expected_revenue, actual_revenue) AS v,
  CASE WHEN expected_revenue IS NOT NULL THEN 'forecast' ELSE 'actual' END AS period_type
  FROM ({ACTUAL_SQL}) FULL JOIN ({FORECAST_SQL}) USING (period) LEFT JOIN fx_target USING (period))""".replace(
    "SELECT *, v / nullif", "SELECT * EXCLUDE (v), v / nullif"),
       floats=f"actual_revenue {CASE_NAMES} target_revenue achievement_rate variance_to_target variance_to_target_pct", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.monthly_view(c.opportunities, c.predictions, c.targets, SALES_AS_OF)


@query("r12_quarterly_vs_target", f"""SELECT *, expected_revenue / nullif(target_revenue, 0) * 100 AS achievement_rate, expected_revenue - target_revenue AS variance_to_target,
  (expected_revenue - target_revenue) / nullif(target_revenue, 0) * 100 AS variance_to_target_pct FROM ({QUARTER_SQL})
  LEFT JOIN (SELECT CAST(date_trunc('quarter', period) AS DATE) AS period, sum(target_revenue) AS target_revenue FROM fx_target GROUP BY 1) USING (period)""",
       floats=f"{QUARTER_NAMES} target_revenue achievement_rate variance_to_target variance_to_target_pct", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.vs_target(revenue.quarterly_forecast(c.opportunities, c.predictions), revenue.quarterly_targets(c.targets))


def _priority_sql(dim: str) -> str:
    return f"""SELECT {dim}, sum(amount * coalesce(win_probability, 0.5::DOUBLE)) AS predicted_revenue, count(DISTINCT opportunity_id) AS opportunity_count
      FROM fx_opportunity LEFT JOIN fx_prediction USING (opportunity_id) WHERE NOT is_closed GROUP BY 1"""


@query("r13_priority_regions", _priority_sql("billing_state"), floats="predicted_revenue", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.priority_by(c.opportunities, c.predictions, "billing_state")


@query("r13_priority_industries", _priority_sql("industry"), floats="predicted_revenue", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.priority_by(c.opportunities, c.predictions, "industry")


LEVEL = "CASE WHEN priority_score >= 100 THEN 'Critical' WHEN priority_score >= 50 THEN 'High' WHEN priority_score >= 20 THEN 'Medium' ELSE 'Low' END AS priority_level"


@query("r14_priority_prospects", f"""SELECT opportunity_id, account_id, amount, win_probability, risk_score, amount * win_probability AS expected_revenue, priority_score, {LEVEL}
  FROM scored_open JOIN fx_prediction USING (opportunity_id) ORDER BY priority_score DESC, opportunity_id LIMIT 20""",
       floats="amount win_probability risk_score expected_revenue priority_score:8", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.priority_prospects(c.opportunities, c.predictions, c.churn)


@query("r15_priority_customers", f"""SELECT *, {LEVEL} FROM (SELECT o_custkey AS account_id, max(l_discount) AS upsell_probability, NULL::DOUBLE AS crosssell_probability,
  max(l_discount) * 100 AS priority_score FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)""", floats="upsell_probability priority_score")
def _(c: Inputs) -> DataFrame:
    rows = c.table("orders").join(c.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return revenue.priority_customers(rows.select(F.col("o_custkey").alias("account_id"), F.col("l_discount").alias("purchase_score")))


@query("r16_rep_actions", f"SELECT opportunity_id, billing_state AS owner, account_id, stage_name, amount, risk_score, risk_level, priority_score, {LEVEL} FROM scored_open",
       floats="amount risk_score priority_score:8", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.rep_actions(c.opportunities, c.churn, None, "billing_state")


@query("r16_rep_risk_summary", """SELECT billing_state AS owner, count(*) AS opportunity_count, count(*) FILTER (risk_level = 'Critical') AS critical_count,
  count(*) FILTER (risk_level = 'High') AS high_count, count(*) FILTER (risk_level = 'Medium') AS medium_count, sum(amount) AS open_amount,
  avg(risk_score) AS avg_risk_score, max(priority_score) AS max_priority_score FROM scored_open GROUP BY 1""",
       floats="open_amount avg_risk_score max_priority_score:8", digits=4)
def _(c: Inputs) -> DataFrame:
    return revenue.rep_risk_summary(revenue.rep_actions(c.opportunities, c.churn, None, "billing_state"))


@query("r16_counts_by_risk", "SELECT risk_level, count(*) AS opportunity_count, sum(amount) AS amount FROM scored_open GROUP BY 1", floats="amount", digits=2)
def _(c: Inputs) -> DataFrame:
    return revenue.counts_by(revenue.rep_actions(c.opportunities, c.churn, None, "billing_state"), "risk_level")


@query("r16_counts_by_stage", "SELECT stage_name, count(*) AS opportunity_count, sum(amount) AS amount FROM scored_open GROUP BY 1", floats="amount", digits=2)
def _(c: Inputs) -> DataFrame:
    return revenue.counts_by(revenue.rep_actions(c.opportunities, c.churn, None, "billing_state"), "stage_name")


# --- recommendations ---------------------------------------------------------------------------------------


def _bought(c: Inputs) -> DataFrame:
    """Purchases, written once: scores, places and factors all read them."""
    orders = c.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("account_id"))
    lines = c.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity")
    )
    return stage(recommend.purchases(orders, lines), "purchases")


def _accounts(c: Inputs) -> DataFrame:
    return c.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("segment"))


COOC_SQL = """SELECT segment, product_id, product_buyers / CAST(buyers AS DOUBLE) AS cooccurrence_score FROM (
  SELECT c_mktsegment AS segment, product_id, count(*) AS product_buyers FROM fx_unit JOIN customer ON account_id = c_custkey GROUP BY 1, 2)
  JOIN (SELECT c_mktsegment AS segment, count(DISTINCT account_id) AS buyers FROM fx_unit JOIN customer ON account_id = c_custkey GROUP BY 1) USING (segment)"""


@query("r17_cooccurrence", COOC_SQL, floats="cooccurrence_score")
def _(c: Inputs) -> DataFrame:
    return recommend.cooccurrence(_bought(c), _accounts(c))


@query("r17_recommend", f"""SELECT account_id, product_id, cooccurrence_score, rank AS recommendation_rank FROM (
  SELECT a.account_id, s.product_id, s.cooccurrence_score, row_number() OVER (PARTITION BY a.account_id ORDER BY s.cooccurrence_score DESC, s.product_id) AS rank
  FROM (SELECT DISTINCT account_id, c_mktsegment AS segment FROM fx_unit JOIN customer ON account_id = c_custkey) a JOIN ({COOC_SQL}) s USING (segment)
  ANTI JOIN fx_unit u ON u.account_id = a.account_id AND u.product_id = s.product_id) WHERE rank <= 5""", floats="cooccurrence_score")
def _(c: Inputs) -> DataFrame:
    return recommend.recommend(_bought(c), _accounts(c))


@query("r17_recommend_cf")
def _(c: Inputs) -> DataFrame:
    bought = _bought(c)
    return recommend.with_cf_score(recommend.recommend(bought, _accounts(c), 10), recommend.fit_cf(bought))


def _copurchase_sql(basket: str) -> str:
    return f"""SELECT product_id, partner_id, baskets, rank FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY baskets DESC, partner_id) AS rank FROM (
    SELECT x.p AS product_id, y.p AS partner_id, count(*) AS baskets FROM ({basket}) x JOIN ({basket}) y ON x.b = y.b AND x.p <> y.p GROUP BY 1, 2)) WHERE rank <= 10"""


@query("r17_copurchase", _copurchase_sql("SELECT DISTINCT l_orderkey AS b, l_partkey AS p FROM lineitem"), ints="rank")
def _(c: Inputs) -> DataFrame:
    lines = c.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
    return copurchase(lines)


@query("r17_copurchase_by_account", _copurchase_sql("SELECT DISTINCT o_custkey AS b, l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey"), ints="rank")
def _(c: Inputs) -> DataFrame:
    """All that an account ever bought is one basket."""
    lines = c.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("product_id"))
    return copurchase(lines.join(c.table("orders").select("o_orderkey", "o_custkey"), "o_orderkey"), basket="o_custkey")


# --- experiments -------------------------------------------------------------------------------------------

AB = "treatment control"
AB_SQL = """count(*) FILTER (test_group = 'treatment') AS treatment_count, count(*) FILTER (test_group = 'control') AS control_count,
  count(*) FILTER (test_group = 'treatment' AND is_purchased) AS treatment_purchases, count(*) FILTER (test_group = 'control' AND is_purchased) AS control_purchases,
  CAST(coalesce(sum(purchase_amount) FILTER (test_group = 'treatment'), 0) AS DOUBLE) AS treatment_revenue, CAST(coalesce(sum(purchase_amount) FILTER (test_group = 'control'), 0) AS DOUBLE) AS control_revenue"""
LIFT_SQL = """SELECT *, t - c AS purchase_rate_lift, (t / nullif(c, 0) - 1) * 100 AS purchase_rate_lift_pct, treatment_revenue - control_revenue AS revenue_lift,
  (treatment_revenue / nullif(control_revenue, 0) - 1) * 100 AS revenue_lift_pct FROM (SELECT *, treatment_purchases / CAST(nullif(treatment_count, 0) AS DOUBLE) AS t,
  control_purchases / CAST(nullif(control_count, 0) AS DOUBLE) AS c FROM (SELECT {dims}, {counts} FROM {source} GROUP BY {n}))"""
AB_FLOATS = "treatment_revenue control_revenue treatment_purchase_rate control_purchase_rate purchase_rate_lift purchase_rate_lift_pct revenue_lift revenue_lift_pct"


def _lift_sql(dims: str, n: str, source: str = "ab_results") -> str:
    inner = LIFT_SQL.format(dims=dims, counts=AB_SQL, source=source, n=n)
    return f"SELECT * RENAME (t AS treatment_purchase_rate, c AS control_purchase_rate) FROM ({inner})"


@query("m1_ab_assign", "SELECT account_id, product_id, test_id, test_start_date, test_group FROM ab_assigned")
def _(c: Inputs) -> DataFrame:
    return c.ab_tests


@query("m2_ab_attribute", "SELECT account_id, product_id, test_group, is_purchased, purchase_date, purchase_amount, opportunity_id FROM ab_results", floats="purchase_amount")
def _(c: Inputs) -> DataFrame:
    return c.ab_results.select("account_id", "product_id", "test_group", "is_purchased", "purchase_date", "purchase_amount", "opportunity_id")


@query("m3_ab_summary", _lift_sql("test_id", "1"), floats=AB_FLOATS, digits=4)
def _(c: Inputs) -> DataFrame:
    return experiments.ab_summary(c.ab_results)


@query("m4_ab_by_day", _lift_sql("test_id, purchase_date", "1, 2"), floats=AB_FLOATS, digits=4)
def _(c: Inputs) -> DataFrame:
    return experiments.ab_by(c.ab_results, "test_id", "purchase_date")


@query("m4_ab_by_product", _lift_sql("product_id", "1"), floats=AB_FLOATS, digits=4)
def _(c: Inputs) -> DataFrame:
    return experiments.ab_by(c.ab_results, "product_id")


@query("m4_ab_by_segment", _lift_sql("c_mktsegment AS customer_segment", "1", "ab_results JOIN customer ON account_id = c_custkey"), floats=AB_FLOATS, digits=4)
def _(c: Inputs) -> DataFrame:
    segments = c.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("customer_segment"))
    return experiments.ab_by(c.ab_results.join(segments, "account_id"), "customer_segment")


@query("m4_ab_by_score_band", _lift_sql("floor((account_id % 100) / 100.0::DOUBLE * 10) / 10 AS score_band", "1"), floats=f"score_band {AB_FLOATS}", digits=4)
def _(c: Inputs) -> DataFrame:
    scored = c.ab_results.withColumn("purchase_score", (F.col("account_id") % 100) / F.lit(100.0))
    return experiments.ab_by(scored, experiments.score_band())


AB_CHI_SQL = f"""SELECT test_id, treatment_purchases, b AS treatment_no_purchases, control_purchases, d AS control_no_purchases,
  (a + b + c + d) * pow(a * d - b * c, 2) / nullif((a + b) * (c + d) * (a + c) * (b + d), 0) AS chi_square FROM (
  SELECT *, CAST(treatment_purchases AS DOUBLE) AS a, CAST(treatment_count - treatment_purchases AS DOUBLE) AS b, CAST(control_purchases AS DOUBLE) AS c,
  CAST(control_count - control_purchases AS DOUBLE) AS d FROM (SELECT test_id, {AB_SQL} FROM ab_results GROUP BY 1))"""


@query("m5_ab_chi_square", AB_CHI_SQL,
       floats="chi_square", ints="treatment_no_purchases control_no_purchases")
def _(c: Inputs) -> DataFrame:
    return experiments.ab_chi_square(c.ab_results)


# P(1 degree) = 1 - erf(sqrt(x / 2)), and erf(s) is the sum of s^(2n+1) exp(-s²) / gamma(n + 3/2); an even number of degrees ends as a Poisson sum
@query("m5_ab_significance", f"""SELECT *, CASE WHEN chi_square = 0 THEN 1 ELSE 1 - (SELECT sum(exp(-chi_square / 2 + (k + 0.5) * ln(chi_square / 2) - lgamma(k + 1.5))) FROM range(300) t(k)) END AS p_value
  FROM ({AB_CHI_SQL})""", floats="chi_square p_value:8", ints="treatment_no_purchases control_no_purchases")
def _(c: Inputs) -> DataFrame:
    return experiments.ab_significance(c.ab_results)


@query("m5_contingency", """SELECT n, d AS degrees, x AS chi_square, (SELECT sum(exp(-x / 2 + k * ln(x / 2) - lgamma(k + 1.0))) FROM range(1000) t(k) WHERE k < d / 2) AS p_value FROM (
  SELECT CAST(sum(n) AS BIGINT) AS n, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS d, sum(n) * (sum(n * n::DOUBLE / rn / cn) - 1) AS x FROM (
  SELECT *, sum(n) OVER (PARTITION BY r) AS rn, sum(n) OVER (PARTITION BY c) AS cn FROM (SELECT stage_name AS r, industry AS c, count(*) AS n FROM fx_opportunity GROUP BY 1, 2)))""",
       floats="chi_square p_value:8", ints="n degrees")
def _(c: Inputs) -> DataFrame:
    return experiments.contingency_test(c.opportunities, "stage_name", "industry")


# --- survival ----------------------------------------------------------------------------------------------


def _survival(c: Inputs) -> DataFrame:
    return survival.survival_dataset(c.opportunities, SALES_AS_OF)


@query("m6_survival_dataset", "SELECT opportunity_id, duration_days, event_lost FROM survival", ints="duration_days event_lost")
def _(c: Inputs) -> DataFrame:
    return _survival(c).select("opportunity_id", "duration_days", "event_lost")


def _km_sql(group: str, part: str) -> str:
    return f"""SELECT {group} duration_days, n AS at_risk, d AS events, CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER ({part} ORDER BY duration_days) = 1 THEN 0
      ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / CAST(n AS DOUBLE)) END) OVER ({part} ORDER BY duration_days)) END AS survival FROM (
      SELECT {group} duration_days, d, sum(l) OVER ({part} ORDER BY duration_days DESC) AS n FROM (SELECT {group} duration_days, count(*) AS l, sum(event_lost) AS d FROM survival GROUP BY ALL))"""


@query("m7_kaplan_meier", _km_sql("", ""), floats="survival", ints="duration_days at_risk events")
def _(c: Inputs) -> DataFrame:
    return survival.kaplan_meier(_survival(c))


@query("m7_kaplan_meier_by_industry", _km_sql("industry,", "PARTITION BY industry"), floats="survival", ints="duration_days at_risk events")
def _(c: Inputs) -> DataFrame:
    return survival.kaplan_meier(_survival(c), ["industry"])


COVARIATES = ["stage_change_count", "amount_variance", "history_record_count", "days_since_created"]


def _features(c: Inputs) -> DataFrame:
    """What models learn from and score, written once: a fit reads its rows at every step."""
    opp = revenue.opportunity_features(c.opportunities, c.opportunity_history, SALES_AS_OF)
    filled = opp.na.fill(0, ["amount_variance"])
    joined = _survival(c).join(filled, "opportunity_id")
    return stage(joined.select("opportunity_id", "is_closed", "is_won", "duration_days", "event_lost", *COVARIATES), "deal-features")


@query("m7_survival_probs")
def _(c: Inputs) -> DataFrame:
    df = _features(c)
    out = survival.survival_probs(df.filter("is_closed"), df.filter("NOT is_closed"), COVARIATES[:3])
    return out.select("opportunity_id", "survival_prob_30d", "survival_prob_60d", "survival_prob_90d")


@query("m7_cox_survival")
def _(c: Inputs) -> DataFrame:
    df = _features(c)
    model = hazards.fit_cox(df.filter("is_closed"), COVARIATES[:3])
    out = hazards.cox_probs(model, df.filter("NOT is_closed"))
    return out.select("opportunity_id", "hazard_ratio", "survival_prob_30d", "survival_prob_60d", "survival_prob_90d", "survival_fitted")


M8_VARS = {"amount": "amount", "opportunity_id": "opportunity_id", "constant": "1"}


@query("m8_variance_report", " UNION ALL ".join(
    f"""SELECT '{n}' AS column_name, var_pop({x}) AS variance, var_pop({x}) FILTER (event_lost = 1) AS variance_event, var_pop({x}) FILTER (event_lost = 0) AS variance_no_event,
    coalesce(var_pop({x}) > 1e-6 AND var_pop({x}) FILTER (event_lost = 1) > 1e-6 AND var_pop({x}) FILTER (event_lost = 0) > 1e-6, false) AS keep
    FROM (SELECT *, amount / 100000 AS x1, opportunity_id / 1000.0::DOUBLE AS x2, 1 AS x3 FROM survival)""".replace(f"({x})", f"({y})").replace(f"'{n}'", f"'{y}'")
    for (n, x), y in zip(M8_VARS.items(), ("x1", "x2", "x3"))), floats="variance variance_event variance_no_event", digits=4)
def _(c: Inputs) -> DataFrame:
    df = _survival(c).select("event_lost", (F.col("amount") / 100000).alias("x1"), (F.col("opportunity_id") / 1000.0).alias("x2"), F.lit(1).alias("x3"))
    return survival.variance_report(df, ["x1", "x2", "x3"])


@query("m8_activity_bins", f"""SELECT CASE WHEN n <= 0 THEN '0' WHEN n <= 3 THEN '1-3' WHEN n <= 10 THEN '4-10' ELSE '11+' END AS activity_bin, count(*) AS accounts
  FROM (SELECT account_id, count(*) FILTER (activity_type = 'task' AND {RECENT}) AS n FROM fx_activity GROUP BY 1) GROUP BY 1""")
def _(c: Inputs) -> DataFrame:
    counts = revenue.activity_features(c.activities, AS_OF)
    return counts.groupBy(activity_bin(F.col("task_count_last_30days")).alias("activity_bin")).agg(F.count("*").alias("accounts"))


# --- models ------------------------------------------------------------------------------------------------


@query("m9_win_classifier")
def _(c: Inputs) -> DataFrame:
    df = _features(c)
    closed = df.filter("is_closed").withColumn("won", F.col("is_won").cast("double"))
    model = modelling.fit_classifier(closed, "won", COVARIATES, maxIter=10)
    return modelling.score(model, df.filter("NOT is_closed"), "win_probability").select("opportunity_id", "win_probability")


RANKED_SQL = """SELECT p, pos, neg, sum(pos) OVER (ORDER BY p) - pos AS pos_below, sum(neg) OVER (ORDER BY p) - neg AS neg_below FROM (
  SELECT win_probability AS p, count(*) FILTER (is_won) AS pos, count(*) FILTER (NOT is_won) AS neg FROM fx_opportunity JOIN fx_prediction USING (opportunity_id)
  WHERE is_closed GROUP BY 1)"""


def _judged(c: Inputs) -> DataFrame:
    return c.opportunities.filter("is_closed").join(c.predictions.select("opportunity_id", "win_probability"), "opportunity_id")


@query("m9_score_quality", f"""SELECT sum(pos + neg) AS n_rows, sum(pos) AS n_positive, sum(pos * (neg_below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc,
  -sum(pos * ln(q) + neg * ln(1 - q)) / sum(pos + neg) AS log_loss, sum(pos * (1 - p) * (1 - p) + neg * p * p) / sum(pos + neg) AS brier
  FROM (SELECT *, least(greatest(p, 1e-15), 1 - 1e-15) AS q FROM ({RANKED_SQL}))""", floats="auc log_loss brier", ints="n_rows n_positive")
def _(c: Inputs) -> DataFrame:
    return evaluation.classifier_quality(_judged(c), "win_probability", "is_won")


@query("m9_calibration", f"""SELECT floor((pos_below + neg_below) * 10.0::DOUBLE / total) AS bin, sum(pos + neg) AS n_rows, sum(p * (pos + neg)) / sum(pos + neg) AS mean_score,
  sum(pos)::DOUBLE / sum(pos + neg) AS share_positive FROM (SELECT *, sum(pos + neg) OVER () AS total FROM ({RANKED_SQL})) GROUP BY 1""",
       floats="mean_score share_positive", ints="bin n_rows")
def _(c: Inputs) -> DataFrame:
    return evaluation.calibration(_judged(c), "win_probability", "is_won")


@query("m9_held_out_quality")
def _(c: Inputs) -> DataFrame:
    """Both kinds of classifier, fitted on seven tenths of the closed deals, on the rest."""
    closed = _features(c).filter("is_closed").withColumn("won", F.col("is_won").cast("int"))
    train, rest = evaluation.split_by_hash(closed, "opportunity_id")
    kinds = {"logistic": {"maxIter": 10}, "gbt": {"maxIter": 5, "maxDepth": 3, "seed": 1}}
    scored = {k: modelling.score(modelling.fit_classifier(train, "won", COVARIATES, k, **p), rest, "p") for k, p in kinds.items()}
    first, second = (evaluation.classifier_quality(df, "p", "won").withColumn("kind", F.lit(k)) for k, df in scored.items())
    return first.unionByName(second)


@query("m10_tree_factors")
def _(c: Inputs) -> DataFrame:
    """The three covariates that move each open deal's score most, by fitted trees."""
    df = _features(c)
    closed = df.filter("is_closed").withColumn("won", F.col("is_won").cast("int"))
    model = modelling.fit_classifier(closed, "won", COVARIATES, "gbt", maxIter=5, maxDepth=3, seed=1)
    found = attribution.top_contributions(attribution.tree_contributions(model, df.filter("NOT is_closed").select("opportunity_id", *COVARIATES)))
    return found.drop("contributions", *COVARIATES)


COEFS = {"p_retailprice": 0.01, "p_size": -0.5, "p_partkey": 0.002, "weight": 3.0}
MEANS = {"p_retailprice": 1400.0, "p_size": 25.0, "p_partkey": 900.0, "weight": 2.0}


@query("m10_top_factors", f"""SELECT p_partkey, names[1] AS risk_factor_1, names[2] AS risk_factor_2, names[3] AS risk_factor_3 FROM (
  SELECT p_partkey, list(name ORDER BY -abs(v), name) AS names FROM (
  {" UNION ALL ".join(f"SELECT p_partkey, '{k}' AS name, {w}::DOUBLE * ({'p_partkey % 5' if k == 'weight' else k} - {MEANS[k]}::DOUBLE) AS v FROM part" for k, w in COEFS.items())}) GROUP BY 1)""")
def _(c: Inputs) -> DataFrame:
    df = c.table("part").withColumn("weight", F.col("p_partkey") % 5)
    return modelling.top_factors(df, COEFS, MEANS).select("p_partkey", "risk_factor_1", "risk_factor_2", "risk_factor_3")


@query("w5_quarter_change", """SELECT period, total, total - lag(total) OVER (ORDER BY period) AS change FROM (
  SELECT CAST(date_trunc('quarter', close_date) AS DATE) AS period, count(*) AS total FROM fx_opportunity GROUP BY 1)""")
def _(c: Inputs) -> DataFrame:
    from pyspark.sql import Window as W

    per_quarter = c.opportunities.groupBy(quarter_start(F.col("close_date")).alias("period")).agg(F.count("*").alias("total"))
    return per_quarter.withColumn("change", F.col("total") - F.lag("total").over(W.orderBy("period")))
