"""Business measures M1-M26 the marts exist for.

Fact-to-fact and fact-to-large-dim questions aggregate each side to the
join grain first (partial aggregation map-side), then join the much smaller
aggregates - never the raw facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import r, safe_div
from tessera.operators import forest
from tessera.oracle.adapter_sql import register as register_sql
from tessera.plans import checks_fulfilment, checks_marts, checks_returns, checks_survey, dims, facts, gen
from tessera.plans.common import share, sql_share
from tessera.plans.registry import query


def _r4(c):
    return r(c, 4)


# ---------------------------------------------------------------- M1 / M15
@query("M15_category_year_returns", """
  SELECT p.CategoryName, a.CalendarYear,
    round(CAST(sum(a.s) AS DOUBLE), 4) AS SalesAmount,
    round(CAST(sum(a.ra) AS DOUBLE), 4) AS ReturnAmount,
    round(CAST(sum(a.da) AS DOUBLE), 4) AS DiscountAmount,
    round(CAST(sum(a.s) - sum(a.ra) - sum(a.da) AS DOUBLE), 4) AS NetSales,
    round(CAST(sum(a.gp) AS DOUBLE), 4) AS GrossProfit,
    CAST(sum(a.q) AS BIGINT) AS SalesQuantity, CAST(sum(a.rq) AS BIGINT) AS ReturnQuantity,
    round(CAST(sum(a.rq) AS DOUBLE) * 100.0 / nullif(CAST(sum(a.q) AS DOUBLE), 0), 4) AS ReturnRatePct
  FROM (SELECT ProductKey, year(OrderDate) AS CalendarYear, sum(SalesAmount) AS s, sum(ReturnAmount) AS ra,
               sum(DiscountAmount) AS da, sum(GrossProfit) AS gp, sum(SalesQuantity) AS q, sum(ReturnQuantity) AS rq
        FROM v_online_sales GROUP BY ProductKey, year(OrderDate)) a
  JOIN v_product p ON a.ProductKey = p.ProductKey
  GROUP BY p.CategoryName, a.CalendarYear""", ("v_online_sales", "v_product"))
def m15(m) -> DataFrame:
    """M1 + M15: net sales (sales - returns - discounts), gross profit and
    return rate (returned qty / sold qty) by product category and year."""
    s = m.get(facts.v_online_sales_lines)
    a = s.groupBy("ProductKey", F.year("OrderDate").alias("CalendarYear")).agg(
        F.sum("SalesAmount").alias("s"), F.sum("ReturnAmount").alias("ra"), F.sum("DiscountAmount").alias("da"),
        F.sum("GrossProfit").alias("gp"), F.sum("SalesQuantity").alias("q"), F.sum("ReturnQuantity").alias("rq"),
    )
    p = m.get(dims.v_product).select("ProductKey", "CategoryName")
    j = a.join(p, "ProductKey")
    g = j.groupBy("CategoryName", "CalendarYear").agg(
        F.sum("s").alias("s"), F.sum("ra").alias("ra"), F.sum("da").alias("da"), F.sum("gp").alias("gp"),
        F.sum("q").alias("q"), F.sum("rq").alias("rq"),
    )
    return g.select(
        "CategoryName", "CalendarYear",
        _r4("s").alias("SalesAmount"), _r4("ra").alias("ReturnAmount"), _r4("da").alias("DiscountAmount"),
        _r4(F.col("s") - F.col("ra") - F.col("da")).alias("NetSales"),
        _r4("gp").alias("GrossProfit"),
        F.col("q").cast("long").alias("SalesQuantity"), F.col("rq").cast("long").alias("ReturnQuantity"),
        F.round(safe_div(F.col("rq") * 100.0, F.col("q")), 4).alias("ReturnRatePct"),
    )


# ----------------------------------------------------------------- helpers


def _cnt():
    return F.count(F.lit(1))


def _d(c):
    return F.col(c).cast("double")


def customer_sales(m) -> DataFrame:
    """Per-customer sales, net sales and gross profit, from the order grain."""
    return gen.order_totals(m).groupBy("CustomerKey").agg(
        F.sum("amt").alias("sales"), F.sum(F.col("amt") - F.col("ra") - F.col("da")).alias("net"),
        F.sum(F.col("amt") - F.col("cost")).alias("gp"), F.min("OrderDate").alias("first"))


register_sql("customer_sales", """
  SELECT CustomerKey, sum(SalesAmount) AS sales, sum(SalesAmount - ReturnAmount - DiscountAmount) AS net,
    sum(SalesAmount - TotalCost) AS gp, CAST(min(DateKey) AS DATE) AS first
  FROM fact_online_sales GROUP BY CustomerKey""", ("fact_online_sales",))


# ---------------------------------------------------------------------- M1
@query("M1_net_sales_by_month", """
  SELECT year(OrderDate) * 100 + month(OrderDate) AS YearMonthKey, CAST(sum(SalesAmount) AS DOUBLE) AS SalesAmount,
    CAST(sum(ReturnAmount) AS DOUBLE) AS ReturnAmount, CAST(sum(DiscountAmount) AS DOUBLE) AS DiscountAmount,
    CAST(sum(SalesAmount) - sum(ReturnAmount) - sum(DiscountAmount) AS DOUBLE) AS NetSales
  FROM v_online_sales GROUP BY 1""", ("v_online_sales",))
def m1(m):
    """M1 net sales = sales - returns - discounts, by (shifted) month."""
    s = m.get(facts.v_online_sales_lines)
    g = s.groupBy((F.year("OrderDate") * 100 + F.month("OrderDate")).alias("YearMonthKey")).agg(
        F.sum("SalesAmount").alias("s"), F.sum("ReturnAmount").alias("r"), F.sum("DiscountAmount").alias("d"))
    return g.select("YearMonthKey", _d("s").alias("SalesAmount"), _d("r").alias("ReturnAmount"),
                    _d("d").alias("DiscountAmount"),
                    (F.col("s") - F.col("r") - F.col("d")).cast("double").alias("NetSales"))


# ---------------------------------------------------------------------- M2
@query("M2_channel_efficiency", """
  SELECT AcquisitionChannelKey, CAST(sum(MonthlySpend) AS DOUBLE) AS Spend, CAST(sum(NewCustomersAcquired) AS BIGINT) AS NewCustomers,
    CAST(sum(Clicks) AS BIGINT) AS Clicks, CAST(sum(Impressions) AS BIGINT) AS Impressions,
    CAST(sum(MonthlySpend) AS DOUBLE) / nullif(CAST(sum(NewCustomersAcquired) AS DOUBLE), 0) AS CAC,
    CAST(sum(MonthlySpend) AS DOUBLE) / nullif(CAST(sum(Clicks) AS DOUBLE), 0) AS CPC,
    CAST(sum(Clicks) AS DOUBLE) * 100.0 / nullif(CAST(sum(Impressions) AS DOUBLE), 0) AS CTRPct
  FROM gen_marketing_spend GROUP BY AcquisitionChannelKey""", ("gen_marketing_spend",))
def m2(m):
    """M2: CAC = spend / new customers, CPC = spend / clicks, CTR = clicks / impressions, by channel."""
    g = m.get(gen.gen_marketing_spend).groupBy("AcquisitionChannelKey").agg(
        F.sum("MonthlySpend").alias("sp"), F.sum("NewCustomersAcquired").alias("n"),
        F.sum("Clicks").alias("c"), F.sum("Impressions").alias("i"))
    return g.select("AcquisitionChannelKey", _d("sp").alias("Spend"), F.col("n").cast("long").alias("NewCustomers"),
                    F.col("c").cast("long").alias("Clicks"), F.col("i").cast("long").alias("Impressions"),
                    safe_div("sp", "n").alias("CAC"), safe_div("sp", "c").alias("CPC"),
                    safe_div(_d("c") * 100.0, "i").alias("CTRPct"))


# ---------------------------------------------------------------------- M3
@query("M3_paid_vs_organic", """
  SELECT c.ChannelType, c.Customers, s.Spend,
    CAST(c.Customers AS DOUBLE) * 100.0 / sum(c.Customers) OVER () AS PctCustomers,
    s.Spend * 100.0 / sum(s.Spend) OVER () AS PctSpend
  FROM (SELECT CASE WHEN ch.ChannelCategory = 'Paid' THEN 'Paid' ELSE 'Organic' END AS ChannelType, count(*) AS Customers
        FROM gen_customer_acquisition a JOIN ref_acquisition_channel ch ON a.AcquisitionChannelKey = ch.AcquisitionChannelKey
        GROUP BY 1) c
  LEFT JOIN (SELECT CASE WHEN ch.ChannelCategory = 'Paid' THEN 'Paid' ELSE 'Organic' END AS ChannelType,
               CAST(sum(MonthlySpend) AS DOUBLE) AS Spend
             FROM gen_marketing_spend s JOIN ref_acquisition_channel ch ON s.AcquisitionChannelKey = ch.AcquisitionChannelKey
             GROUP BY 1) s ON c.ChannelType = s.ChannelType""",
       ("gen_customer_acquisition", "gen_marketing_spend", "ref_acquisition_channel"))
def m3(m):
    """M3: paid vs organic (= not Paid) customers and their spend mix."""
    ch = m.ref_acquisition_channel.select(
        "AcquisitionChannelKey",
        F.when(F.col("ChannelCategory") == "Paid", "Paid").otherwise("Organic").alias("ChannelType"))
    c = m.get(gen.gen_customer_acquisition).groupBy("AcquisitionChannelKey").agg(_cnt().alias("n")) \
        .join(ch, "AcquisitionChannelKey").groupBy("ChannelType").agg(F.sum("n").alias("Customers"))
    s = m.get(gen.gen_marketing_spend).groupBy("AcquisitionChannelKey").agg(F.sum("MonthlySpend").alias("sp")) \
        .join(ch, "AcquisitionChannelKey").groupBy("ChannelType").agg(F.sum("sp").cast("double").alias("Spend"))
    j = c.join(s, "ChannelType", "left")
    w = Window.partitionBy()
    return j.select("ChannelType", "Customers", "Spend",
                    (_d("Customers") * 100.0 / F.sum("Customers").over(w)).alias("PctCustomers"),
                    (F.col("Spend") * 100.0 / F.sum("Spend").over(w)).alias("PctSpend"))


# ----------------------------------------------------------------- M4 / M5
_SQL_CH_CUST = """
  SELECT a.AcquisitionChannelKey, count(*) AS Customers, sum(cs.net) AS net, sum(cs.gp) AS gp,
    sum((year(sc.max_date) * 12 + month(sc.max_date)) - (year(cs.first) * 12 + month(cs.first)) + 1) AS months
  FROM gen_customer_acquisition a JOIN customer_sales cs ON a.CustomerKey = cs.CustomerKey CROSS JOIN scalars sc
  GROUP BY a.AcquisitionChannelKey"""


def _channel_customers(m):
    """Per channel: customers, their net sales, gross profit and customer-months
    (per-customer aggregate first, then the customer-grain join)."""
    cs = m.with_scalars(customer_sales(m), "max_date")
    months = (F.year("max_date") * 12 + F.month("max_date")) - (F.year("first") * 12 + F.month("first")) + 1
    j = m.get(gen.gen_customer_acquisition).select("CustomerKey", "AcquisitionChannelKey").join(cs, "CustomerKey")
    return j.groupBy("AcquisitionChannelKey").agg(_cnt().alias("Customers"), F.sum("net").alias("net"),
                                                  F.sum("gp").alias("gp"), F.sum(months).alias("months"))


@query("M4_clv_by_channel", f"""
  SELECT g.AcquisitionChannelKey, g.Customers, CAST(g.net AS DOUBLE) / g.Customers AS AvgCLV,
    CAST(CAST((ch.EstimatedCACLow + ch.EstimatedCACHigh) / 2 AS DECIMAL(19,4)) AS DOUBLE) AS CACMidpoint,
    (CAST(g.net AS DOUBLE) / g.Customers) / nullif(CAST(CAST((ch.EstimatedCACLow + ch.EstimatedCACHigh) / 2 AS DECIMAL(19,4)) AS DOUBLE), 0) AS CLVtoCAC
  FROM ({_SQL_CH_CUST}) g JOIN ref_acquisition_channel ch ON g.AcquisitionChannelKey = ch.AcquisitionChannelKey""",
       ("gen_customer_acquisition", "customer_sales", "scalars", "ref_acquisition_channel"))
def m4(m):
    """M4: customer lifetime value (average net sales per acquired customer) and CLV : CAC midpoint."""
    g = _channel_customers(m).join(m.ref_acquisition_channel, "AcquisitionChannelKey")
    mid = ((F.col("EstimatedCACLow") + F.col("EstimatedCACHigh")) / 2).cast("decimal(19,4)").cast("double")
    clv = _d("net") / F.col("Customers")
    return g.select("AcquisitionChannelKey", "Customers", clv.alias("AvgCLV"), mid.alias("CACMidpoint"),
                    (clv / F.nullif(mid, F.lit(0.0))).alias("CLVtoCAC"))


@query("M5_payback_months", f"""
  SELECT g.AcquisitionChannelKey, CAST(g.gp AS DOUBLE) / CAST(g.months AS DOUBLE) AS MonthlyGrossProfitPerCustomer,
    CAST(CAST((ch.EstimatedCACLow + ch.EstimatedCACHigh) / 2 AS DECIMAL(19,4)) AS DOUBLE)
      / nullif(CAST(g.gp AS DOUBLE) / CAST(g.months AS DOUBLE), 0) AS PaybackMonths
  FROM ({_SQL_CH_CUST}) g JOIN ref_acquisition_channel ch ON g.AcquisitionChannelKey = ch.AcquisitionChannelKey""",
       ("gen_customer_acquisition", "customer_sales", "scalars", "ref_acquisition_channel"))
def m5(m):
    """M5: payback months = CAC midpoint / monthly gross profit per customer, where the
    monthly figure pools gross profit over customer-months since first purchase."""
    g = _channel_customers(m).join(m.ref_acquisition_channel, "AcquisitionChannelKey")
    mid = ((F.col("EstimatedCACLow") + F.col("EstimatedCACHigh")) / 2).cast("decimal(19,4)").cast("double")
    mgp = _d("gp") / _d("months")
    return g.select("AcquisitionChannelKey", mgp.alias("MonthlyGrossProfitPerCustomer"),
                    (mid / F.nullif(mgp, F.lit(0.0))).alias("PaybackMonths"))


# ---------------------------------------------------------------------- M6
@query("M6_roas", """
  SELECT r.AcquisitionChannelKey, CAST(r.rev AS DOUBLE) AS Revenue, CAST(s.sp AS DOUBLE) AS Spend,
    CAST(r.rev AS DOUBLE) / nullif(CAST(s.sp AS DOUBLE), 0) AS ROAS,
    CAST(s.sp AS DOUBLE) * 100.0 / nullif(CAST(r.rev AS DOUBLE), 0) AS SpendPctOfRevenue
  FROM (SELECT a.AcquisitionChannelKey, sum(cs.sales) AS rev FROM gen_customer_acquisition a
        JOIN customer_sales cs ON a.CustomerKey = cs.CustomerKey GROUP BY 1) r
  LEFT JOIN (SELECT AcquisitionChannelKey, sum(MonthlySpend) AS sp FROM gen_marketing_spend GROUP BY 1) s
    ON r.AcquisitionChannelKey = s.AcquisitionChannelKey""",
       ("gen_customer_acquisition", "customer_sales", "gen_marketing_spend"))
def m6(m):
    """M6: return on ad spend (revenue of acquired customers / spend) and spend as % of revenue."""
    r = m.get(gen.gen_customer_acquisition).select("CustomerKey", "AcquisitionChannelKey") \
        .join(customer_sales(m).select("CustomerKey", "sales"), "CustomerKey") \
        .groupBy("AcquisitionChannelKey").agg(F.sum("sales").alias("rev"))
    s = m.get(gen.gen_marketing_spend).groupBy("AcquisitionChannelKey").agg(F.sum("MonthlySpend").alias("sp"))
    j = r.join(s, "AcquisitionChannelKey", "left")
    return j.select("AcquisitionChannelKey", _d("rev").alias("Revenue"), _d("sp").alias("Spend"),
                    safe_div("rev", "sp").alias("ROAS"), safe_div(_d("sp") * 100.0, "rev").alias("SpendPctOfRevenue"))


# ---------------------------------------------------------------------- M7
@query("M7_digital_share_yoy", """
  SELECT SourceYear, DigitalPct, DigitalPct - lag(DigitalPct) OVER (ORDER BY SourceYear) AS ChangePts
  FROM (SELECT op.OrderDateKey // 10000 AS SourceYear,
          CAST(count(*) FILTER (WHERE pm.IsDigital) AS DOUBLE) * 100.0 / count(*) AS DigitalPct
        FROM gen_order_payment op JOIN ref_payment_method pm ON op.PaymentMethodKey = pm.PaymentMethodKey
        GROUP BY 1) y""", ("gen_order_payment", "ref_payment_method"))
def m7(m):
    """M7: digital payment share by year and its change against the previous year."""
    j = m.get(gen.gen_order_payment).join(m.ref_payment_method.select("PaymentMethodKey", "IsDigital"),
                                           "PaymentMethodKey")
    y = j.groupBy(F.floor(F.col("OrderDateKey") / 10000).cast("int").alias("SourceYear")).agg(
        (F.count_if(F.col("IsDigital")).cast("double") * 100.0 / _cnt()).alias("DigitalPct"))
    w = Window.orderBy("SourceYear")  # one row per year
    return y.select("SourceYear", "DigitalPct", (F.col("DigitalPct") - F.lag("DigitalPct").over(w)).alias("ChangePts"))


# ---------------------------------------------------------------------- M8
@query("M8_bnpl_and_high_value", """
  SELECT count(*) FILTER (WHERE PaymentMethodKey = 7) AS BNPLOrders,
    CAST(sum(OrderValue) FILTER (WHERE PaymentMethodKey = 7) AS DOUBLE) AS BNPLValue,
    CAST(sum(OrderValue) FILTER (WHERE PaymentMethodKey = 7) AS DOUBLE) / nullif(count(*) FILTER (WHERE PaymentMethodKey = 7), 0) AS BNPLAvgOrderValue,
    count(*) FILTER (WHERE OrderValue > 500) AS HighValueOrders,
    count(*) FILTER (WHERE OrderValue > 500 AND PaymentMethodKey = 4) AS BankTransferHighValueOrders,
    CAST(count(*) FILTER (WHERE OrderValue > 500 AND PaymentMethodKey = 4) AS DOUBLE) * 100.0
      / nullif(count(*) FILTER (WHERE OrderValue > 500), 0) AS BankTransferPctOfHighValue
  FROM gen_order_payment""", ("gen_order_payment",))
def m8(m):
    """M8: BNPL exposure and average order value; bank-transfer share of orders above 500."""
    p = m.get(gen.gen_order_payment)
    bnpl, hv = F.col("PaymentMethodKey") == 7, F.col("OrderValue") > 500
    g = p.agg(F.count_if(bnpl).alias("BNPLOrders"), F.sum(F.when(bnpl, F.col("OrderValue"))).alias("bv"),
              F.count_if(hv).alias("HighValueOrders"),
              F.count_if(hv & (F.col("PaymentMethodKey") == 4)).alias("BankTransferHighValueOrders"))
    return g.select("BNPLOrders", _d("bv").alias("BNPLValue"), safe_div("bv", "BNPLOrders").alias("BNPLAvgOrderValue"),
                    "HighValueOrders", "BankTransferHighValueOrders",
                    safe_div(_d("BankTransferHighValueOrders") * 100.0, "HighValueOrders")
                    .alias("BankTransferPctOfHighValue"))


# ---------------------------------------------------------------------- M9
register_sql("order_customer", """
  SELECT op.SalesOrderNumber, op.CustomerKey, coalesce(g.ContinentName, 'Unknown') AS CustomerContinent
  FROM order_profile op LEFT JOIN dim_customer c ON op.CustomerKey = c.CustomerKey
  LEFT JOIN dim_geography g ON c.GeographyKey = g.GeographyKey""", ("order_profile", "dim_customer", "dim_geography"))


def order_customer(m) -> DataFrame:
    """Order -> customer and customer continent, from the orders alone; joined on
    the numeric order key."""
    c = m.dim_customer.select("CustomerKey", "GeographyKey")
    j = m.order_heads.select("OrderKey", "CustomerKey").join(c, "CustomerKey", "left") \
        .join(m.dim_geography.select("GeographyKey", "ContinentName"), "GeographyKey", "left")
    return j.select("OrderKey", "CustomerKey", F.coalesce("ContinentName", F.lit("Unknown")).alias("CustomerContinent"))


def _order_key():
    """Numeric key of 'SO<key>'."""
    return F.substring("SalesOrderNumber", 3, 40).cast("long").alias("OrderKey")


@query("M9_payment_by_region", f"""
  SELECT oc.CustomerContinent, p.PaymentMethodKey, count(*) AS Orders,
    {sql_share('count(*)', 'oc.CustomerContinent')} AS PctWithinRegion
  FROM gen_order_payment p JOIN order_customer oc ON p.SalesOrderNumber = oc.SalesOrderNumber
  GROUP BY oc.CustomerContinent, p.PaymentMethodKey""", ("gen_order_payment", "order_customer"))
def m9(m):
    """M9: payment-method mix by customer continent (order-grain join, then aggregate)."""
    j = m.get(gen.gen_order_payment).select(_order_key(), "PaymentMethodKey").join(
        order_customer(m).select("OrderKey", "CustomerContinent"), "OrderKey")
    g = j.groupBy("CustomerContinent", "PaymentMethodKey").agg(_cnt().alias("Orders"))
    return share(g, "Orders", "PctWithinRegion", ["CustomerContinent"])


# --------------------------------------------------------------------- M10
@query("M10_payment_return_cancel_rates", """
  SELECT p.PaymentMethodKey, count(*) AS Orders,
    count(*) FILTER (WHERE f.FulfillmentStatus = 'Cancelled') AS CancelledOrders,
    count(*) FILTER (WHERE f.FulfillmentStatus = 'Returned') AS ReturnedOrders,
    count(*) FILTER (WHERE r.SalesOrderNumber IS NOT NULL) AS OrdersWithLineReturns,
    CAST(count(*) FILTER (WHERE f.FulfillmentStatus = 'Cancelled') AS DOUBLE) * 100.0 / count(*) AS CancelRatePct,
    CAST(count(*) FILTER (WHERE f.FulfillmentStatus = 'Returned' OR r.SalesOrderNumber IS NOT NULL) AS DOUBLE) * 100.0 / count(*) AS ReturnRatePct
  FROM gen_order_payment p JOIN gen_order_fulfillment f ON p.SalesOrderNumber = f.SalesOrderNumber
  LEFT JOIN (SELECT DISTINCT SalesOrderNumber FROM gen_online_returns) r ON p.SalesOrderNumber = r.SalesOrderNumber
  GROUP BY p.PaymentMethodKey""", ("gen_order_payment", "gen_order_fulfillment", "gen_online_returns"))
def m10(m):
    """Cancel and return rates by payment method (cash on delivery is key 5),
    all joins at order grain; line returns are reduced to one row per order first."""
    r = m.get(gen.gen_online_returns).groupBy("SalesOrderNumber").agg(F.lit(True).alias("has_ret"))
    j = (m.get(gen.gen_order_payment).select("SalesOrderNumber", "PaymentMethodKey")
         .join(m.get(gen.gen_order_fulfillment).select("SalesOrderNumber", "FulfillmentStatus"), "SalesOrderNumber")
         .join(r, "SalesOrderNumber", "left"))
    st, hr = F.col("FulfillmentStatus"), F.col("has_ret").isNotNull()
    g = j.groupBy("PaymentMethodKey").agg(
        _cnt().alias("Orders"), F.count_if(st == "Cancelled").alias("CancelledOrders"),
        F.count_if(st == "Returned").alias("ReturnedOrders"), F.count_if(hr).alias("OrdersWithLineReturns"),
        F.count_if((st == "Returned") | hr).alias("ret"))
    return g.select("PaymentMethodKey", "Orders", "CancelledOrders", "ReturnedOrders", "OrdersWithLineReturns",
                    (_d("CancelledOrders") * 100.0 / F.col("Orders")).alias("CancelRatePct"),
                    (_d("ret") * 100.0 / F.col("Orders")).alias("ReturnRatePct"))


# --------------------------------------------------------------- M11 / M12
@query("M11_on_time_by_method_region", """
  SELECT f.ShippingMethod, oc.CustomerContinent, count(*) AS Orders, CAST(sum(f.IsOnTime) AS BIGINT) AS OnTimeOrders,
    CAST(sum(f.IsOnTime) AS DOUBLE) * 100.0 / count(*) AS OnTimePct
  FROM v_order_fulfillment f JOIN order_customer oc ON f.SalesOrderNumber = oc.SalesOrderNumber
  GROUP BY f.ShippingMethod, oc.CustomerContinent""", ("v_order_fulfillment", "order_customer"))
def m11(m):
    """On-time % (delivered within 7 days / all orders) by shipping method and region."""
    j = m.get(checks_fulfilment.v_order_fulfillment).select(_order_key(), "ShippingMethod", "IsOnTime") \
        .join(order_customer(m).select("OrderKey", "CustomerContinent"), "OrderKey")
    g = j.groupBy("ShippingMethod", "CustomerContinent").agg(_cnt().alias("Orders"),
                                                            F.sum("IsOnTime").cast("long").alias("OnTimeOrders"))
    return g.withColumn("OnTimePct", _d("OnTimeOrders") * 100.0 / F.col("Orders"))


@query("M12_delay_root_cause", f"""
  SELECT DelayRootCause, count(*) AS Orders, {sql_share('count(*)')} AS PctOfCompleted,
    CAST(sum(TotalFulfillmentDays) AS DOUBLE) / count(*) AS AvgTotalDays
  FROM v_order_fulfillment WHERE DelayRootCause IS NOT NULL GROUP BY DelayRootCause""", ("v_order_fulfillment",))
def m12(m):
    """Split of completed orders by delay root cause.

    Root cause is non-NULL exactly for Delivered/Returned orders (the only ones
    with a total); filtering on the status keeps the predicate Catalyst pushes
    below the fulfilment projection small instead of inlining the whole
    lifecycle expression into it."""
    v = m.get(checks_fulfilment.v_order_fulfillment).where(F.col("FulfillmentStatus").isin("Delivered", "Returned"))
    g = v.groupBy("DelayRootCause").agg(_cnt().alias("Orders"),
                                        (F.sum("TotalFulfillmentDays").cast("double") / _cnt()).alias("AvgTotalDays"))
    return share(g, "Orders", "PctOfCompleted")


# --------------------------------------------------------------------- M13
@query("M13_nps_csat_trend", """
  SELECT year(SurveyDate) * 100 + month(SurveyDate) AS YearMonthKey, count(*) AS Responses,
    CAST(sum(NPSContribution) AS DOUBLE) * 100.0 / count(*) AS NPS,
    CAST(sum(IsSatisfied) AS DOUBLE) * 100.0 / count(*) AS CSATPct
  FROM v_customer_survey GROUP BY 1""", ("v_customer_survey",))
def m13(m):
    """NPS (% promoters - % detractors) and CSAT % by survey month."""
    v = m.get(checks_survey.v_customer_survey)
    return v.groupBy((F.year("SurveyDate") * 100 + F.month("SurveyDate")).alias("YearMonthKey")).agg(
        _cnt().alias("Responses"), (F.sum("NPSContribution").cast("double") * 100.0 / _cnt()).alias("NPS"),
        (F.sum("IsSatisfied").cast("double") * 100.0 / _cnt()).alias("CSATPct"))


# --------------------------------------------------------------------- M14
@query("M14_nps_by_channel", """
  SELECT a.AcquisitionChannelKey, count(*) AS Respondents, CAST(sum(s.n) AS BIGINT) AS Responses,
    CAST(sum(s.contrib) AS DOUBLE) * 100.0 / sum(s.n) AS NPS, CAST(sum(s.sat) AS DOUBLE) * 100.0 / sum(s.n) AS CSATPct,
    CAST(sum(cs.net) AS DOUBLE) / count(*) AS AvgCLVOfRespondents,
    CAST(coalesce(sum(cs.net) FILTER (WHERE s.detractor), 0) AS DOUBLE) AS RevenueAtRisk
  FROM (SELECT CustomerKey, count(*) AS n, sum(NPSContribution) AS contrib, sum(IsSatisfied) AS sat,
          bool_or(NPSContribution = -1) AS detractor FROM v_customer_survey GROUP BY CustomerKey) s
  JOIN gen_customer_acquisition a ON s.CustomerKey = a.CustomerKey
  JOIN customer_sales cs ON s.CustomerKey = cs.CustomerKey
  GROUP BY a.AcquisitionChannelKey""", ("v_customer_survey", "gen_customer_acquisition", "customer_sales"))
def m14(m):
    """NPS and CSAT by acquisition channel, CLV of respondents and the net
    sales of customers who gave a detractor score (revenue at risk)."""
    s = m.get(checks_survey.v_customer_survey).groupBy("CustomerKey").agg(
        _cnt().alias("n"), F.sum("NPSContribution").alias("contrib"), F.sum("IsSatisfied").alias("sat"),
        F.max((F.col("NPSContribution") == -1).cast("int")).alias("det"))
    j = s.join(m.get(gen.gen_customer_acquisition).select("CustomerKey", "AcquisitionChannelKey"), "CustomerKey") \
        .join(customer_sales(m).select("CustomerKey", "net"), "CustomerKey")
    g = j.groupBy("AcquisitionChannelKey").agg(
        _cnt().alias("Respondents"), F.sum("n").cast("long").alias("Responses"),
        F.sum("contrib").alias("c"), F.sum("sat").alias("st"), F.sum("net").alias("net"),
        F.sum(F.when(F.col("det") == 1, F.col("net"))).alias("risk"))
    return g.select("AcquisitionChannelKey", "Respondents", "Responses",
                    (_d("c") * 100.0 / F.col("Responses")).alias("NPS"),
                    (_d("st") * 100.0 / F.col("Responses")).alias("CSATPct"),
                    (_d("net") / F.col("Respondents")).alias("AvgCLVOfRespondents"),
                    F.coalesce(_d("risk"), F.lit(0.0)).alias("RevenueAtRisk"))


# --------------------------------------------------------------------- M16
@query("M16_refunds_by_reason_channel", """
  SELECT v.ReturnChannel, r.ReturnReasonName, count(*) AS Returns, CAST(sum(v.RefundAmount) AS DOUBLE) AS RefundLiability,
    CAST(count(*) FILTER (WHERE v.IsRefunded) AS DOUBLE) * 100.0 / count(*) AS RefundRatePct
  FROM v_returns v JOIN ref_return_reason r ON v.ReturnReasonKey = r.ReturnReasonKey
  GROUP BY v.ReturnChannel, r.ReturnReasonName""", ("v_returns", "ref_return_reason"))
def m16(m):
    """Refund liability and refund rate by reason and channel."""
    v = checks_returns.v_returns_unkeyed(m)
    g = v.groupBy("ReturnChannel", "ReturnReasonKey").agg(
        _cnt().alias("Returns"), F.sum("RefundAmount").cast("double").alias("RefundLiability"),
        F.count_if(F.col("IsRefunded")).alias("ref"))
    g = g.join(m.ref_return_reason.select("ReturnReasonKey", "ReturnReasonName"), "ReturnReasonKey")
    return g.select("ReturnChannel", "ReturnReasonName", "Returns", "RefundLiability",
                    (_d("ref") * 100.0 / F.col("Returns")).alias("RefundRatePct"))


# --------------------------------------------------------------------- M17
@query("M17_operational_failure_share", """
  SELECT p.CategoryName, count(*) AS Returns, count(*) FILTER (WHERE r.IsOperationalFailure) AS OperationalFailureReturns,
    CAST(count(*) FILTER (WHERE r.IsOperationalFailure) AS DOUBLE) * 100.0 / count(*) AS OperationalFailurePct
  FROM v_returns v JOIN ref_return_reason r ON v.ReturnReasonKey = r.ReturnReasonKey
  JOIN v_product p ON v.ProductKey = p.ProductKey
  GROUP BY p.CategoryName""", ("v_returns", "ref_return_reason", "v_product"))
def m17(m):
    """Share of returns caused by operational failures, by product category
    (returns reduced to product grain before the product join)."""
    v = checks_returns.v_returns_unkeyed(m).join(
        m.ref_return_reason.select("ReturnReasonKey", "IsOperationalFailure"), "ReturnReasonKey")
    g = v.groupBy("ProductKey").agg(_cnt().alias("n"), F.count_if(F.col("IsOperationalFailure")).alias("op"))
    g = g.join(m.get(dims.v_product).select("ProductKey", "CategoryName"), "ProductKey")
    g = g.groupBy("CategoryName").agg(F.sum("n").alias("Returns"), F.sum("op").alias("OperationalFailureReturns"))
    return g.withColumn("OperationalFailurePct", _d("OperationalFailureReturns") * 100.0 / F.col("Returns"))


# --------------------------------------------------------------------- M18
@query("M18_return_cohort", """
  SELECT year(OriginalSaleDate) * 100 + month(OriginalSaleDate) AS SaleYearMonth, ReturnChannel, count(*) AS Returns,
    CAST(sum(ReturnAmount) AS DOUBLE) AS ReturnAmount, CAST(sum(ReturnLagDays) AS DOUBLE) / count(*) AS AvgLagDays
  FROM v_returns GROUP BY 1, 2""", ("v_returns",))
def m18(m):
    """Returns by the month of the original sale (the inactive date of the returns fact)."""
    v = checks_returns.v_returns_unkeyed(m)
    return v.groupBy((F.year("OriginalSaleDate") * 100 + F.month("OriginalSaleDate")).alias("SaleYearMonth"),
                     "ReturnChannel").agg(
        _cnt().alias("Returns"), F.sum("ReturnAmount").cast("double").alias("ReturnAmount"),
        (F.sum("ReturnLagDays").cast("double") / _cnt()).alias("AvgLagDays"))


# --------------------------------------------------------------------- M19
@query("M19_current_stock", """
  SELECT StockStatus, count(*) AS Positions, CAST(sum(OnHandQuantity) AS BIGINT) AS OnHandQuantity,
    CAST(sum(InventoryValue) AS DOUBLE) AS InventoryValue
  FROM v_inventory WHERE IsCurrentSnapshot = 1 GROUP BY StockStatus""", ("v_inventory",))
def m19(m):
    """Current stock only (latest snapshot); snapshots are never summed across dates."""
    v = m.get(checks_marts.v_inventory).where(F.col("IsCurrentSnapshot") == 1)
    return v.groupBy("StockStatus").agg(_cnt().alias("Positions"),
                                        F.sum("OnHandQuantity").cast("long").alias("OnHandQuantity"),
                                        F.sum("InventoryValue").cast("double").alias("InventoryValue"))


# --------------------------------------------------------------------- M20
@query("M20_quota_vs_actual", """
  SELECT q.CalendarYear, q.ChannelName, CAST(q.quota AS DOUBLE) AS QuotaAmount, CAST(a.actual AS DOUBLE) AS ActualAmount,
    CAST(a.actual AS DOUBLE) * 100.0 / nullif(CAST(q.quota AS DOUBLE), 0) AS AttainmentPct
  FROM (SELECT year(SalesQuotaDate) AS CalendarYear, ChannelName, sum(SalesAmountQuota) AS quota
        FROM v_sales_quota WHERE ScenarioName = 'Budget' GROUP BY 1, 2) q
  LEFT JOIN (SELECT year(s.SaleDate) AS CalendarYear, ch.ChannelName, sum(s.SalesAmount) AS actual
             FROM v_store_sales s JOIN dim_channel ch ON s.ChannelKey = ch.ChannelKey GROUP BY 1, 2) a
    ON q.CalendarYear = a.CalendarYear AND q.ChannelName = a.ChannelName""",
       ("v_sales_quota", "v_store_sales", "dim_channel"))
def m20(m, scenario: str = "Budget"):
    """Quota vs actual store sales by year and channel, one scenario at a time."""
    q = m.get(checks_marts.v_sales_quota).where(F.col("ScenarioName") == scenario) \
        .groupBy(F.year("SalesQuotaDate").alias("CalendarYear"), "ChannelName") \
        .agg(F.sum("SalesAmountQuota").alias("quota"))
    a = m.get(facts.v_store_sales_lines).groupBy(F.year("SaleDate").alias("CalendarYear"), "ChannelKey") \
        .agg(F.sum("SalesAmount").alias("actual")) \
        .join(m.dim_channel.select("ChannelKey", "ChannelName"), "ChannelKey") \
        .groupBy("CalendarYear", "ChannelName").agg(F.sum("actual").alias("actual"))
    j = q.join(a, ["CalendarYear", "ChannelName"], "left")
    return j.select("CalendarYear", "ChannelName", _d("quota").alias("QuotaAmount"), _d("actual").alias("ActualAmount"),
                    safe_div(_d("actual") * 100.0, "quota").alias("AttainmentPct"))


# --------------------------------------------------------------------- M21
@query("M21_fx_conversion", """
  SELECT s.CurrencyKey, CAST(sum(s.amt) AS DOUBLE) AS SalesAmount,
    CAST(sum(CAST(s.amt AS DECIMAL(18,4)) * CAST(r.AverageRate AS DECIMAL(12,6))) AS DOUBLE) AS ConvertedAmount,
    CAST(sum(CAST(r.AverageRate AS DECIMAL(12,6))) FILTER (WHERE NOT r.IsBaseCurrency) AS DOUBLE)
      / count(*) FILTER (WHERE NOT r.IsBaseCurrency) AS AvgRateExBase
  FROM (SELECT CurrencyKey, year(OrderDate) * 100 + month(OrderDate) AS YearMonthKey, sum(SalesAmount) AS amt
        FROM v_online_sales GROUP BY 1, 2) s
  JOIN v_exchange_rate r ON s.CurrencyKey = r.CurrencyKey AND s.YearMonthKey = r.YearMonthKey
  GROUP BY s.CurrencyKey""", ("v_online_sales", "v_exchange_rate"))
def m21(m):
    """Sales converted at the monthly average rate of their currency; sales are
    aggregated to (currency, month) before the rate join. Base-currency rows are
    left out of the average rate."""
    s = m.get(facts.v_online_sales_lines).groupBy(
        "CurrencyKey", (F.year("OrderDate") * 100 + F.month("OrderDate")).alias("YearMonthKey")).agg(
        F.sum("SalesAmount").alias("amt"))
    r = m.get(checks_marts.v_exchange_rate).select("CurrencyKey", "YearMonthKey", "AverageRate", "IsBaseCurrency")
    j = s.join(F.broadcast(r), ["CurrencyKey", "YearMonthKey"])  # currencies x months: bounded by the calendar
    rate = F.col("AverageRate").cast("decimal(12,6)")  # exact sums, so the result is order-independent
    return j.groupBy("CurrencyKey").agg(
        F.sum("amt").cast("double").alias("SalesAmount"),
        # (25,4) x (12,6) stays within 38 digits, so the products are exact
        F.sum(F.col("amt").cast("decimal(25,4)") * rate).cast("double").alias("ConvertedAmount"),
        (F.sum(F.when(~F.col("IsBaseCurrency"), rate)).cast("double")
         / F.count_if(~F.col("IsBaseCurrency"))).alias("AvgRateExBase"))


# --------------------------------------------------------------------- M22
@query("M22_promo_vs_nonpromo", """
  SELECT PromotionKey <> 1 AS IsPromotion, count(*) AS Lines, CAST(sum(SalesAmount) AS DOUBLE) AS SalesAmount,
    CAST(sum(DiscountAmount) AS DOUBLE) AS DiscountAmount,
    CAST(sum(DiscountAmount) AS DOUBLE) * 100.0 / nullif(CAST(sum(SalesAmount) + sum(DiscountAmount) AS DOUBLE), 0) AS DiscountPct
  FROM v_online_sales GROUP BY 1""", ("v_online_sales",))
def m22(m):
    """Promoted (PromotionKey <> 1) vs full-price lines."""
    g = m.get(facts.v_online_sales_lines).groupBy((F.col("PromotionKey") != 1).alias("IsPromotion")).agg(
        _cnt().alias("Lines"), F.sum("SalesAmount").alias("s"), F.sum("DiscountAmount").alias("d"))
    return g.select("IsPromotion", "Lines", _d("s").alias("SalesAmount"), _d("d").alias("DiscountAmount"),
                    safe_div(_d("d") * 100.0, (F.col("s") + F.col("d")).cast("double")).alias("DiscountPct"))


# --------------------------------------------------------------------- M23
@query("M23_repeat_and_basket", """
  SELECT count(*) AS Orders, count(DISTINCT CustomerKey) AS Customers,
    (SELECT count(*) FROM (SELECT CustomerKey FROM order_profile GROUP BY CustomerKey HAVING count(*) >= 2) x) AS RepeatCustomers,
    CAST(sum(ItemCount) AS DOUBLE) / count(*) AS AvgBasketLines, CAST(sum(OrderValue) AS DOUBLE) / count(*) AS AvgOrderValue
  FROM order_profile""", ("order_profile",))
def m23(m):
    """Repeat-purchase customers and basket size per order (order grain)."""
    op = gen.order_profile(m)
    per_c = op.groupBy("CustomerKey").agg(_cnt().alias("n"))
    a = op.agg(_cnt().alias("Orders"), F.sum("ItemCount").alias("items"), F.sum("OrderValue").alias("val"))
    c = per_c.agg(_cnt().alias("Customers"), F.count_if(F.col("n") >= 2).alias("RepeatCustomers"))
    j = a.crossJoin(c)
    return j.select("Orders", "Customers", "RepeatCustomers", (_d("items") / F.col("Orders")).alias("AvgBasketLines"),
                    (_d("val") / F.col("Orders")).alias("AvgOrderValue"))


# --------------------------------------------------------------------- M24
@query("M24_return_band_clv", """
  SELECT CASE WHEN b.ReturnRate = 0 THEN '1 none' WHEN b.ReturnRate < 0.05 THEN '2 low' WHEN b.ReturnRate < 0.15 THEN '3 mid'
              ELSE '4 high' END AS ReturnBand,
    count(*) AS Customers, CAST(sum(cs.net) AS DOUBLE) / count(*) AS AvgCLV
  FROM customer_behaviour b JOIN customer_sales cs ON b.CustomerKey = cs.CustomerKey GROUP BY 1""",
       ("customer_behaviour", "customer_sales"))
def m24(m):
    """High-return customers vs their lifetime value (return-rate bands of the survey model)."""
    b = gen.customer_behaviour(m).select("CustomerKey", "ReturnRate").join(
        customer_sales(m).select("CustomerKey", "net"), "CustomerKey")
    rr = F.col("ReturnRate")
    band = F.when(rr == 0, "1 none").when(rr < 0.05, "2 low").when(rr < 0.15, "3 mid").otherwise("4 high")
    return b.groupBy(band.alias("ReturnBand")).agg(_cnt().alias("Customers"),
                                                   (F.sum("net").cast("double") / _cnt()).alias("AvgCLV"))


@query("M24_csat_by_segment", """
  SELECT c.AgeGroup, c.IncomeGroup, count(*) AS Responses, CAST(sum(s.IsSatisfied) AS DOUBLE) * 100.0 / count(*) AS CSATPct
  FROM v_customer_survey s JOIN v_customer c ON s.CustomerKey = c.CustomerKey
  GROUP BY c.AgeGroup, c.IncomeGroup""", ("v_customer_survey", "v_customer"))
def m24b(m):
    """CSAT by age and income segment (worst segments sort first by CSATPct)."""
    j = m.get(checks_survey.v_customer_survey).select("CustomerKey", "IsSatisfied").join(
        m.get(dims.v_customer).select("CustomerKey", "AgeGroup", "IncomeGroup"), "CustomerKey")
    return j.groupBy("AgeGroup", "IncomeGroup").agg(
        _cnt().alias("Responses"), (F.sum("IsSatisfied").cast("double") * 100.0 / _cnt()).alias("CSATPct"))


# --------------------------------------------------------------------- M25
@query("M25_spend_vs_season", """
  SELECT s.YearMonth, CAST(s.sp AS DOUBLE) AS Spend, CAST(si.SeasonIndex AS DOUBLE) AS SeasonIndex,
    CAST(s.sp * count(*) OVER () AS DOUBLE) / CAST(sum(s.sp) OVER () AS DOUBLE) AS SpendIndex
  FROM (SELECT YearMonth, sum(MonthlySpend) AS sp FROM gen_marketing_spend GROUP BY YearMonth) s
  LEFT JOIN monthly_seasonality si ON s.YearMonth = si.YearMonth""", ("gen_marketing_spend", "monthly_seasonality"))
def m25(m):
    """Monthly spend index next to the revenue season index."""
    s = m.get(gen.gen_marketing_spend).groupBy("YearMonth").agg(F.sum("MonthlySpend").alias("sp"))
    j = s.join(gen.monthly_seasonality(m).select("YearMonth", "SeasonIndex"), "YearMonth", "left")
    w = Window.partitionBy()  # one row per month
    return j.select("YearMonth", _d("sp").alias("Spend"), _d("SeasonIndex").alias("SeasonIndex"),
                    ((F.col("sp") * F.count(F.lit(1)).over(w)).cast("double") / F.sum("sp").over(w).cast("double"))
                    .alias("SpendIndex"))


# --------------------------------------------------------------------- M26
_ORG_SQL = """
  WITH RECURSIVE org(EmployeeKey, ParentEmployeeKey, Depth, Path) AS (
    SELECT EmployeeKey, ParentEmployeeKey, 0, CAST(EmployeeKey AS {s})
    FROM {t} e WHERE ParentEmployeeKey IS NULL
       OR NOT EXISTS (SELECT 1 FROM {t} p WHERE p.EmployeeKey = e.ParentEmployeeKey)
    UNION ALL
    SELECT c.EmployeeKey, c.ParentEmployeeKey, o.Depth + 1, o.Path || '/' || CAST(c.EmployeeKey AS {s})
    FROM {t} c JOIN org o ON c.ParentEmployeeKey = o.EmployeeKey
  )
  SELECT EmployeeKey, ParentEmployeeKey, Depth, Path FROM org"""


@query("M26_org_chart", "SELECT * FROM (" + _ORG_SQL.format(s="VARCHAR", t="dim_employee") + ") o", ("dim_employee",))
def m26(m):
    """Org chart depth and path from the self-referencing parent key, by
    pointer doubling: rounds grow with the logarithm of the depth."""
    return forest(m.dim_employee, "EmployeeKey", "ParentEmployeeKey")[0]


# ------------------------------------------- M14, M15, M17, M23 by other axes
def _return_rate(g: DataFrame, *by: str) -> DataFrame:
    return g.select(*by, _r4("s").alias("SalesAmount"), F.col("q").cast("long").alias("SalesQuantity"), F.col("rq").cast("long").alias("ReturnQuantity"),
                    F.round(safe_div(F.col("rq") * 100.0, F.col("q")), 4).alias("ReturnRatePct"))


def _sums():
    return [F.sum("SalesAmount").alias("s"), F.sum("SalesQuantity").alias("q"), F.sum("ReturnQuantity").alias("rq")]


_SQL_RATE = """round(CAST(sum(SalesAmount) AS DOUBLE), 4) AS SalesAmount, CAST(sum(SalesQuantity) AS BIGINT) AS SalesQuantity,
    CAST(sum(ReturnQuantity) AS BIGINT) AS ReturnQuantity,
    round(CAST(sum(ReturnQuantity) AS DOUBLE) * 100.0 / nullif(CAST(sum(SalesQuantity) AS DOUBLE), 0), 4) AS ReturnRatePct"""
_SQL_BOTH = """(SELECT 'Online' AS SalesChannel, StoreKey, ProductKey, SalesAmount, SalesQuantity, ReturnQuantity FROM fact_online_sales
    UNION ALL SELECT 'Store', StoreKey, ProductKey, SalesAmount, SalesQuantity, ReturnQuantity FROM fact_sales)"""


def _both_channels(m, *by: str) -> DataFrame:
    """Online and in-store sales and returns, summed by channel and ``by``."""
    cols = [*by, "SalesAmount", "SalesQuantity", "ReturnQuantity"]
    on = m.order_lines.select(F.lit("Online").alias("SalesChannel"), *cols)
    st = m.store_line_sums.select(F.lit("Store").alias("SalesChannel"), *cols)
    return on.unionByName(st).groupBy("SalesChannel", *by).agg(*_sums())


def _again(g: DataFrame, *by: str) -> DataFrame:
    return g.groupBy(*by).agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("rq").alias("rq"))


@query("M15_channel_returns", f"SELECT SalesChannel, {_SQL_RATE} FROM {_SQL_BOTH} x GROUP BY SalesChannel", ("fact_online_sales", "fact_sales"))
def m15_channel(m):
    """Sales and return rate online against in store."""
    return _return_rate(_both_channels(m), "SalesChannel")


@query("M15_store_returns", f"""SELECT SalesChannel, x.StoreKey, any_value(s.StoreName) AS StoreName, {_SQL_RATE}
  FROM {_SQL_BOTH} x JOIN v_store s ON s.StoreKey = x.StoreKey GROUP BY SalesChannel, x.StoreKey""", ("fact_online_sales", "fact_sales", "v_store"))
def m15_store(m):
    """Return rate of every store, online and in store."""
    g = _both_channels(m, "StoreKey").join(m.get(dims.v_store).select("StoreKey", "StoreName"), "StoreKey")
    return _return_rate(g, "SalesChannel", "StoreKey", "StoreName")


@query("M15_subcategory_returns", f"""SELECT SalesChannel, p.CategoryName, p.SubcategoryName, {_SQL_RATE}
  FROM {_SQL_BOTH} x JOIN v_product p ON p.ProductKey = x.ProductKey GROUP BY SalesChannel, p.CategoryName, p.SubcategoryName""",
       ("fact_online_sales", "fact_sales", "v_product"))
def m15_subcategory(m):
    """Return rate by category and subcategory, online and in store."""
    g = _both_channels(m, "ProductKey").join(m.get(dims.v_product).select("ProductKey", "CategoryName", "SubcategoryName"), "ProductKey")
    return _return_rate(_again(g, "SalesChannel", "CategoryName", "SubcategoryName"), "SalesChannel", "CategoryName", "SubcategoryName")


@query("M14_clv_by_nps_category", """
  SELECT s.NPSCategory, count(*) AS Customers, CAST(sum(cs.net) AS DOUBLE) / count(*) AS AvgCLV, CAST(sum(cs.net) AS DOUBLE) AS TotalCLV
  FROM (SELECT DISTINCT CustomerKey, NPSCategory FROM v_customer_survey) s JOIN customer_sales cs ON cs.CustomerKey = s.CustomerKey
  GROUP BY s.NPSCategory""", ("v_customer_survey", "customer_sales"))
def m14_clv(m):
    """Lifetime value of the customers that ever answered in each NPS category."""
    s = m.get(checks_survey.v_customer_survey).select("CustomerKey", "NPSCategory").distinct()
    g = s.join(customer_sales(m).select("CustomerKey", "net"), "CustomerKey").groupBy("NPSCategory").agg(_cnt().alias("Customers"), F.sum("net").alias("net"))
    return g.select("NPSCategory", "Customers", (_d("net") / F.col("Customers")).alias("AvgCLV"), _d("net").alias("TotalCLV"))


@query("M14_csat_vs_return_rate", """
  SELECT CASE WHEN b.ReturnRate = 0 THEN '1 none' WHEN b.ReturnRate < 0.05 THEN '2 low' WHEN b.ReturnRate < 0.15 THEN '3 mid' ELSE '4 high' END AS ReturnBand,
    count(*) AS Responses, CAST(sum(s.CSATScore) AS DOUBLE) / count(*) AS AvgCSATScore, CAST(sum(s.IsSatisfied) AS DOUBLE) * 100.0 / count(*) AS CSATPct
  FROM v_customer_survey s JOIN customer_behaviour b ON b.CustomerKey = s.CustomerKey GROUP BY 1""", ("v_customer_survey", "customer_behaviour"))
def m14_csat(m):
    """Satisfaction by the customer's return rate (bands of the survey model)."""
    rr = F.col("ReturnRate")
    band = F.when(rr == 0, "1 none").when(rr < 0.05, "2 low").when(rr < 0.15, "3 mid").otherwise("4 high")
    s = m.get(checks_survey.v_customer_survey).groupBy("CustomerKey").agg(_cnt().alias("n"), F.sum("CSATScore").alias("score"), F.sum("IsSatisfied").alias("sat"))
    j = s.join(gen.customer_behaviour(m).select("CustomerKey", "ReturnRate"), "CustomerKey")
    g = j.groupBy(band.alias("ReturnBand")).agg(F.sum("n").alias("Responses"), F.sum("score").alias("score"), F.sum("sat").alias("sat"))
    return g.select("ReturnBand", "Responses", (_d("score") / F.col("Responses")).alias("AvgCSATScore"),
                    (_d("sat") * 100.0 / F.col("Responses")).alias("CSATPct"))


@query("M17_product_failures", """
  SELECT v.ReturnChannel, v.ProductKey, any_value(p.ProductName) AS ProductName, any_value(p.CategoryName) AS CategoryName, count(*) AS Returns,
    count(*) FILTER (WHERE r.IsOperationalFailure) AS OperationalFailureReturns,
    CAST(count(*) FILTER (WHERE r.IsOperationalFailure) AS DOUBLE) * 100.0 / count(*) AS OperationalFailurePct
  FROM v_returns v JOIN ref_return_reason r ON v.ReturnReasonKey = r.ReturnReasonKey JOIN v_product p ON v.ProductKey = p.ProductKey
  GROUP BY v.ReturnChannel, v.ProductKey""", ("v_returns", "ref_return_reason", "v_product"))
def m17_product(m):
    """Returns and operational failures of every product, by channel."""
    v = checks_returns.v_returns_unkeyed(m).join(m.ref_return_reason.select("ReturnReasonKey", "IsOperationalFailure"), "ReturnReasonKey")
    g = v.groupBy("ReturnChannel", "ProductKey").agg(_cnt().alias("Returns"), F.count_if(F.col("IsOperationalFailure")).alias("OperationalFailureReturns"))
    g = g.join(m.get(dims.v_product).select("ProductKey", "ProductName", "CategoryName"), "ProductKey")
    return g.select("ReturnChannel", "ProductKey", "ProductName", "CategoryName", "Returns", "OperationalFailureReturns",
                    (_d("OperationalFailureReturns") * 100.0 / F.col("Returns")).alias("OperationalFailurePct"))


@query("M23_purchase_cohort", """
  SELECT year(f) * 100 + month(f) AS CohortMonth, (year(OrderDate) * 12 + month(OrderDate)) - (year(f) * 12 + month(f)) AS MonthsSince,
    count(DISTINCT CustomerKey) AS ActiveCustomers, count(*) AS Orders, CAST(sum(OrderValue) AS DOUBLE) AS Revenue
  FROM (SELECT *, min(OrderDate) OVER (PARTITION BY CustomerKey) AS f FROM order_profile) x GROUP BY 1, 2""", ("order_profile",))
def m23_cohort(m):
    """Cohorts of first purchase by months since: active customers, orders
    and revenue. Orders are summed per customer and month first."""
    month = F.year("OrderDate") * 12 + F.month("OrderDate")
    per = gen.order_profile(m).groupBy("CustomerKey", month.alias("mo")).agg(_cnt().alias("n"), F.sum("OrderValue").alias("v"))
    first = per.groupBy("CustomerKey").agg(F.min("mo").alias("f"))
    j = per.join(first, "CustomerKey")
    g = j.groupBy("f", (F.col("mo") - F.col("f")).alias("MonthsSince")).agg(
        _cnt().alias("ActiveCustomers"), F.sum("n").alias("Orders"), F.sum("v").cast("double").alias("Revenue"))
    cohort = F.floor((F.col("f") - 1) / 12) * 100 + F.pmod(F.col("f") - 1, F.lit(12)) + 1
    return g.select(cohort.cast("int").alias("CohortMonth"), "MonthsSince", "ActiveCustomers", "Orders", "Revenue")
