"""P5 surveys: pipeline query, fact view V19 and checks Q33-Q38, Q71."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, shift
from tessera.operators import distinct_counts, metric_rows, missing_in, sql_metric_rows
from tessera.oracle.adapter_sql import register
from tessera.plans import gen
from tessera.plans.common import SHIFT, share, sql_share
from tessera.plans.registry import query

TRIGGERS = {"Post-Purchase": 1, "Quarterly": 2, "Annual": 3}  # fixed values (trigger codes)


def _cnt():
    return F.count(F.lit(1))


@query("P5_customer_survey", "SELECT * FROM gen_customer_survey", ("gen_customer_survey",))
def p5(m):
    return m.get(gen.gen_customer_survey)


def v_customer_survey(m) -> DataFrame:
    """V19 fact.vCustomerSurvey: shifted date pair, NPS contribution, IsSatisfied flag."""
    s = m.get(gen.gen_customer_survey)
    d = shift(F.col("SurveyDate"), SHIFT)
    return s.select(
        "SurveyResponseID", "CustomerKey", date_key(d).alias("SurveyDateKey"), d.alias("SurveyDate"),
        "NPSScore", "NPSCategory",
        F.when(F.col("NPSCategory") == "Promoter", 1).when(F.col("NPSCategory") == "Detractor", -1).otherwise(0)
        .alias("NPSContribution"),
        "CSATScore", F.when(F.col("CSATScore") >= 4, 1).otherwise(0).alias("IsSatisfied"),
        "WouldRecommend", "SurveyTrigger",
    )


register("v_customer_survey", f"""
  SELECT SurveyResponseID, CustomerKey, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS SurveyDateKey,
    d AS SurveyDate, NPSScore, NPSCategory,
    CASE NPSCategory WHEN 'Promoter' THEN 1 WHEN 'Detractor' THEN -1 ELSE 0 END AS NPSContribution,
    CSATScore, CASE WHEN CSATScore >= 4 THEN 1 ELSE 0 END AS IsSatisfied, WouldRecommend, SurveyTrigger
  FROM (SELECT *, CAST(SurveyDate + INTERVAL {SHIFT} YEAR AS DATE) AS d FROM gen_customer_survey) s""",
         ("gen_customer_survey",))


@query("V19_customer_survey", "SELECT * FROM v_customer_survey", ("v_customer_survey",))
def v19(m):
    return m.get(v_customer_survey)


_SQL_GRAIN = ("CAST(CustomerKey AS BIGINT) * 100 + CASE SurveyTrigger "
              + " ".join(f"WHEN '{n}' THEN {c}" for n, c in TRIGGERS.items()) + " ELSE 0 END")


@query("Q33_survey_grain", f"""
  SELECT count(*) AS TotalResponses, count(DISTINCT CustomerKey) AS UniqueCustomersSurveyed,
    count(*) FILTER (WHERE SurveyTrigger = 'Post-Purchase') AS PostPurchaseRows,
    count(*) FILTER (WHERE SurveyTrigger = 'Quarterly') AS QuarterlyRows,
    count(*) FILTER (WHERE SurveyTrigger = 'Annual') AS AnnualRows,
    count(*) - count(DISTINCT {_SQL_GRAIN}) AS DuplicateGrainRows
  FROM gen_customer_survey""", ("gen_customer_survey",))
def q33(m):
    s = m.get(gen.gen_customer_survey)
    at = {name: F.col("SurveyTrigger") == name for name in TRIGGERS}
    counts = {"PostPurchaseRows": "Post-Purchase", "QuarterlyRows": "Quarterly", "AnnualRows": "Annual"}
    # customers as a whole and under each trigger; a trigger beyond the known ones counts as one more
    row = distinct_counts(s, F.col("CustomerKey"), {"UniqueCustomersSurveyed": None, "g0": ~F.coalesce(F.col("SurveyTrigger").isin(*TRIGGERS), F.lit(False)),
                                                    **{f"g{code}": at[name] for name, code in TRIGGERS.items()}},
                          {"TotalResponses": _cnt(), **{out: F.count_if(at[name]) for out, name in counts.items()}})
    grains = sum((F.col(f"g{code}") for code in TRIGGERS.values()), F.col("g0"))
    return row.select("TotalResponses", "UniqueCustomersSurveyed", *counts, (F.col("TotalResponses") - grains).alias("DuplicateGrainRows"))


def _contrib():
    return F.when(F.col("NPSScore") >= 9, 1).when(F.col("NPSScore") >= 7, 0).otherwise(-1)


_SQL_CONTRIB = "CASE WHEN NPSScore >= 9 THEN 1 WHEN NPSScore >= 7 THEN 0 ELSE -1 END"


@query("Q34_nps_category_share", f"""
  SELECT NPSCategory, count(*) AS ResponseCount, {sql_share('count(*)')} AS PctOfTotal,
    CAST(sum(NPSScore) AS DOUBLE) / count(*) AS AvgNPSScore, CAST(sum({_SQL_CONTRIB}) AS BIGINT) AS SumContributions
  FROM gen_customer_survey GROUP BY NPSCategory""", ("gen_customer_survey",))
def q34(m):
    g = m.get(gen.gen_customer_survey).groupBy("NPSCategory").agg(
        _cnt().alias("ResponseCount"), (F.sum("NPSScore").cast("double") / _cnt()).alias("AvgNPSScore"),
        F.sum(_contrib()).cast("long").alias("SumContributions"))
    return share(g, "ResponseCount", "PctOfTotal")


@query("Q35_overall_nps", f"""
  SELECT 'Computed NPS Score' AS Metric, CAST(sum({_SQL_CONTRIB}) AS DOUBLE) / nullif(count(*), 0) * 100 AS Value
  FROM gen_customer_survey""", ("gen_customer_survey",))
def q35(m):
    s = m.get(gen.gen_customer_survey)
    return s.agg((F.sum(_contrib()).cast("double") / F.nullif(_cnt(), F.lit(0)) * 100).alias("Value")) \
        .select(F.lit("Computed NPS Score").alias("Metric"), "Value")


@query("Q36_csat_by_nps_category", """
  SELECT NPSCategory, count(*) AS ResponseCount, CAST(sum(CSATScore) AS DOUBLE) / count(*) AS AvgCSATScore,
    count(*) FILTER (WHERE CSATCategory = 'Satisfied') AS SatisfiedCount,
    count(*) FILTER (WHERE CSATCategory = 'Neutral') AS NeutralCount,
    count(*) FILTER (WHERE CSATCategory = 'Dissatisfied') AS DissatisfiedCount,
    CAST(count(*) FILTER (WHERE WouldRecommend) AS DOUBLE) / nullif(count(*), 0) * 100 AS PctWouldRecommend
  FROM gen_customer_survey GROUP BY NPSCategory""", ("gen_customer_survey",))
def q36(m):
    s = m.get(gen.gen_customer_survey)
    return s.groupBy("NPSCategory").agg(
        _cnt().alias("ResponseCount"), (F.sum("CSATScore").cast("double") / _cnt()).alias("AvgCSATScore"),
        F.count_if(F.col("CSATCategory") == "Satisfied").alias("SatisfiedCount"),
        F.count_if(F.col("CSATCategory") == "Neutral").alias("NeutralCount"),
        F.count_if(F.col("CSATCategory") == "Dissatisfied").alias("DissatisfiedCount"),
        (F.count_if(F.col("WouldRecommend")).cast("double") / F.nullif(_cnt(), F.lit(0)) * 100)
        .alias("PctWouldRecommend"))


@query("Q37_behaviour_by_nps_category", """
  SELECT s.NPSCategory, count(DISTINCT s.CustomerKey) AS UniqueCustomers,
    CAST(sum(b.TotalOrders) AS DOUBLE) / count(*) AS AvgOrders,
    CAST(sum(b.TotalSpend) AS DOUBLE) / count(*) AS AvgLifetimeSpend,
    CAST(sum(CAST(b.ReturnRate AS DECIMAL(18,12))) AS DOUBLE) / count(*) AS AvgReturnRate
  FROM gen_customer_survey s JOIN customer_behaviour b ON s.CustomerKey = b.CustomerKey
  GROUP BY s.NPSCategory""", ("gen_customer_survey", "customer_behaviour"))
def q37(m):
    """Behaviour per NPS category: the per-customer aggregate is built first,
    then joined to the (much smaller) survey rows."""
    b = gen.customer_behaviour(m).select("CustomerKey", "TotalOrders", "TotalSpend", "ReturnRate")
    j = m.get(gen.gen_customer_survey).select("CustomerKey", "NPSCategory").join(b, "CustomerKey")
    return j.groupBy("NPSCategory").agg(
        F.countDistinct("CustomerKey").alias("UniqueCustomers"),
        (F.sum("TotalOrders").cast("double") / _cnt()).alias("AvgOrders"),
        (F.sum("TotalSpend").cast("double") / _cnt()).alias("AvgLifetimeSpend"),
        # exact decimals: the sum does not depend on the order of rows
        (F.sum(F.col("ReturnRate").cast("decimal(18,12)")).cast("double") / _cnt()).alias("AvgReturnRate"))


# --- fixed values: check labels ----------------------------------------------
Q38_LABELS = ["Orphan CustomerKeys", "Duplicate (CustomerKey, SurveyTrigger) pairs", "NPSScore out of range (0–10)",
              "CSATScore out of range (1–5)", "WouldRecommend mismatch (NPSScore >= 9 must = 1)",
              "SurveyDate after MaxDate", "Invalid SurveyTrigger value"]
# -----------------------------------------------------------------------------


@query("Q38_survey_integrity", sql_metric_rows(f"""
    SELECT count(*) - count(c.CustomerKey) AS c1, count(*) - count(DISTINCT (s.CustomerKey, s.SurveyTrigger)) AS c2,
      sum(CASE WHEN NPSScore < 0 OR NPSScore > 10 THEN 1 ELSE 0 END) AS c3, sum(CASE WHEN CSATScore < 1 OR CSATScore > 5 THEN 1 ELSE 0 END) AS c4,
      sum(CASE WHEN WouldRecommend <> (NPSScore >= 9) THEN 1 ELSE 0 END) AS c5, sum(CASE WHEN SurveyDate > max_date THEN 1 ELSE 0 END) AS c6,
      sum(CASE WHEN list_contains([{', '.join(f"'{t}'" for t in TRIGGERS)}], SurveyTrigger) THEN 0 ELSE 1 END) AS c7
    FROM gen_customer_survey s LEFT JOIN dim_customer c ON c.CustomerKey = s.CustomerKey CROSS JOIN scalars""",
    [(label, f"c{i + 1}") for i, label in enumerate(Q38_LABELS)], "Check"), ("gen_customer_survey", "dim_customer", "scalars"))
def q38(m):
    """Survey rules in one pass."""
    s = m.with_scalars(missing_in(m.get(gen.gen_customer_survey), m.dim_customer, "CustomerKey", "orphan"), "max_date")
    rules = [F.col("orphan"), None, ~F.col("NPSScore").between(0, 10), ~F.col("CSATScore").between(1, 5),
             F.col("WouldRecommend") != (F.col("NPSScore") >= 9), F.col("SurveyDate") > F.col("max_date"),
             ~F.col("SurveyTrigger").isin(*TRIGGERS)]
    row = s.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules) if rule is not None],
                (_cnt() - F.countDistinct("CustomerKey", "SurveyTrigger")).alias("c1"))
    return metric_rows(row, [(label, F.col(f"c{i}")) for i, label in enumerate(Q38_LABELS)], "Check", "Value")


@query("Q71_nps_trigger_satisfied", f"""
  SELECT NPSCategory, NPSContribution, SurveyTrigger, IsSatisfied, count(*) AS ResponseCount,
    {sql_share('count(*)')} AS PctOfTotal
  FROM v_customer_survey GROUP BY NPSCategory, NPSContribution, SurveyTrigger, IsSatisfied""",
       ("v_customer_survey",))
def q71(m):
    g = m.get(v_customer_survey).groupBy("NPSCategory", "NPSContribution", "SurveyTrigger", "IsSatisfied") \
        .agg(_cnt().alias("ResponseCount"))
    return share(g, "ResponseCount", "PctOfTotal")
