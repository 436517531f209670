"""P3 fulfilment: pipeline query, fact view V18 and checks Q21-Q27, Q69."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, shift
from tessera.operators import metric_rows, missing_in, sql_metric_rows
from tessera.oracle.adapter_sql import register
from tessera.plans import gen
from tessera.plans.common import SHIFT, share, sql_share
from tessera.plans.registry import query

# --- fixed values: SLA / tier labels -----------------------------------------
SLA_EXPRESS, SLA_STANDARD = 3, 7
TIER_LABELS = [(3, "1 — Express (≤3d)"), (7, "2 — Standard (4–7d)"), (14, "3 — Delayed (8–14d)")]
TIER_LATE = "4 — Late (>14d)"
# -----------------------------------------------------------------------------


def _cnt():
    return F.count(F.lit(1))


@query("P3_order_fulfillment", "SELECT * FROM gen_order_fulfillment", ("gen_order_fulfillment",))
def p3(m):
    return m.get(gen.gen_order_fulfillment)


def v_order_fulfillment(m) -> DataFrame:
    """V18 fact.vOrderFulfillment: shifted date pairs (NULL-safe), SLA, tier, root cause, on-time flag."""
    f = m.get(gen.gen_order_fulfillment)
    od, sd, dd = (shift(F.col(c), SHIFT) for c in ("OrderDate", "ShipDate", "DeliveryDate"))
    tot, proc, tr = F.col("TotalFulfillmentDays"), F.col("ProcessingDays"), F.col("TransitDays")
    st = F.col("FulfillmentStatus")
    tier = F.when(tot.isNull(), F.lit(None).cast("string"))
    for lim, lab in TIER_LABELS:
        tier = tier.when(tot <= lim, lab)
    return f.select(
        "SalesOrderNumber",
        date_key(od).alias("OrderDateKey"), od.alias("OrderDate"),
        date_key(sd).alias("ShipDateKey"), sd.alias("ShipDate"),
        date_key(dd).alias("DeliveryDateKey"), dd.alias("DeliveryDate"),
        "FulfillmentStatus", "ShippingMethod", "ProcessingDays", "TransitDays", "TotalFulfillmentDays",
        F.when(st != "Delivered", "In Progress").when(tot <= SLA_EXPRESS, "Express SLA Met")
        .when(tot <= SLA_STANDARD, "Standard SLA Met").otherwise("SLA Breached").alias("SLAStatus"),
        tier.otherwise(TIER_LATE).alias("FulfillmentTier"),
        F.when(tot.isNull(), F.lit(None)).when(proc > tr, "Warehouse Bottleneck")
        .when(tr > proc * 2, "Carrier Delay").otherwise("Balanced").alias("DelayRootCause"),
        F.when((st == "Delivered") & (tot <= SLA_STANDARD), 1).otherwise(0).alias("IsOnTime"),
    )


def _dk(c):
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


register("v_order_fulfillment", f"""
  SELECT SalesOrderNumber, {_dk('od')} AS OrderDateKey, od AS OrderDate, {_dk('sd')} AS ShipDateKey, sd AS ShipDate,
    {_dk('dd')} AS DeliveryDateKey, dd AS DeliveryDate, FulfillmentStatus, ShippingMethod, ProcessingDays, TransitDays,
    TotalFulfillmentDays,
    CASE WHEN FulfillmentStatus <> 'Delivered' THEN 'In Progress' WHEN TotalFulfillmentDays <= 3 THEN 'Express SLA Met'
         WHEN TotalFulfillmentDays <= 7 THEN 'Standard SLA Met' ELSE 'SLA Breached' END AS SLAStatus,
    CASE WHEN TotalFulfillmentDays IS NULL THEN NULL
         {' '.join(f"WHEN TotalFulfillmentDays <= {lim} THEN '{lab}'" for lim, lab in TIER_LABELS)}
         ELSE '{TIER_LATE}' END AS FulfillmentTier,
    CASE WHEN TotalFulfillmentDays IS NULL THEN NULL WHEN ProcessingDays > TransitDays THEN 'Warehouse Bottleneck'
         WHEN TransitDays > ProcessingDays * 2 THEN 'Carrier Delay' ELSE 'Balanced' END AS DelayRootCause,
    CASE WHEN FulfillmentStatus = 'Delivered' AND TotalFulfillmentDays <= 7 THEN 1 ELSE 0 END AS IsOnTime
  FROM (SELECT *, CAST(OrderDate + INTERVAL {SHIFT} YEAR AS DATE) AS od, CAST(ShipDate + INTERVAL {SHIFT} YEAR AS DATE) AS sd,
          CAST(DeliveryDate + INTERVAL {SHIFT} YEAR AS DATE) AS dd FROM gen_order_fulfillment) f""",
         ("gen_order_fulfillment",))


@query("V18_order_fulfillment", "SELECT * FROM v_order_fulfillment", ("v_order_fulfillment",))
def v18(m):
    return m.get(v_order_fulfillment)


@query("Q21_orders_vs_fulfilment", """
  SELECT 'Source distinct orders' AS Metric, count(DISTINCT SalesOrderNumber) AS Value FROM fact_online_sales
  UNION ALL SELECT 'gen.OrderFulfillment rows', count(*) FROM gen_order_fulfillment
  UNION ALL SELECT 'Delta (expect 0)', abs((SELECT count(DISTINCT SalesOrderNumber) FROM fact_online_sales)
                                           - (SELECT count(*) FROM gen_order_fulfillment))
  UNION ALL SELECT 'Orders with no fulfilment record (expect 0)', count(DISTINCT f.SalesOrderNumber)
    FROM fact_online_sales f
    WHERE NOT EXISTS (SELECT 1 FROM gen_order_fulfillment g WHERE g.SalesOrderNumber = f.SalesOrderNumber)""",
       ("fact_online_sales", "gen_order_fulfillment"))
def q21(m):
    """Distinct order numbers of the sales lines against the fulfilment table."""
    src = m.order_lines.select("SalesOrderNumber").distinct()
    of = m.get(gen.gen_order_fulfillment)
    done = of.select("SalesOrderNumber").distinct().withColumn("done", F.lit(True))
    orders = src.join(done, "SalesOrderNumber", "left").agg(_cnt().alias("src"), F.count_if(F.col("done").isNull()).alias("miss"))
    row = orders.crossJoin(of.agg(_cnt().alias("of")))
    return metric_rows(row, [
        ("Source distinct orders", F.col("src")), ("gen.OrderFulfillment rows", F.col("of")),
        ("Delta (expect 0)", F.abs(F.col("src") - F.col("of"))),
        ("Orders with no fulfilment record (expect 0)", F.col("miss")),
    ])


@query("Q22_status_share", f"""
  SELECT FulfillmentStatus, count(*) AS OrderCount, {sql_share('count(*)')} AS PctOfTotal
  FROM gen_order_fulfillment GROUP BY FulfillmentStatus""", ("gen_order_fulfillment",))
def q22(m):
    g = m.get(gen.gen_order_fulfillment).groupBy("FulfillmentStatus").agg(_cnt().alias("OrderCount"))
    return share(g, "OrderCount", "PctOfTotal")


@query("Q23_shipping_method_share", f"""
  SELECT ShippingMethod, count(*) AS OrderCount, {sql_share('count(*)')} AS PctOfTotal,
    CAST(sum(TotalFulfillmentDays) AS DOUBLE) / count(TotalFulfillmentDays) AS AvgFulfilmentDays
  FROM gen_order_fulfillment WHERE FulfillmentStatus = 'Delivered' GROUP BY ShippingMethod""",
       ("gen_order_fulfillment",))
def q23(m):
    """Shipping mix of delivered orders. The mean is exact (the reference's integer AVG truncates)."""
    f = m.get(gen.gen_order_fulfillment).where(F.col("FulfillmentStatus") == "Delivered")
    g = f.groupBy("ShippingMethod").agg(
        _cnt().alias("OrderCount"),
        (F.sum("TotalFulfillmentDays").cast("double") / F.count("TotalFulfillmentDays")).alias("AvgFulfilmentDays"))
    return share(g, "OrderCount", "PctOfTotal")


def _avg(c):
    return (F.sum(c).cast("double") / F.count(c)).alias(f"Avg{c.replace('Fulfillment', '').replace('Days', '')}Days")


def _sql_avg(c, alias):
    return f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {alias}"


@query("Q24_days_by_method", f"""
  SELECT ShippingMethod, count(*) AS Orders, {_sql_avg('ProcessingDays', 'AvgProcessingDays')},
    {_sql_avg('TransitDays', 'AvgTransitDays')}, {_sql_avg('TotalFulfillmentDays', 'AvgTotalDays')},
    min(TotalFulfillmentDays) AS MinTotalDays, max(TotalFulfillmentDays) AS MaxTotalDays
  FROM gen_order_fulfillment WHERE FulfillmentStatus = 'Delivered' GROUP BY ShippingMethod""",
       ("gen_order_fulfillment",))
def q24(m):
    f = m.get(gen.gen_order_fulfillment).where(F.col("FulfillmentStatus") == "Delivered")
    return f.groupBy("ShippingMethod").agg(
        _cnt().alias("Orders"), _avg("ProcessingDays"), _avg("TransitDays"), _avg("TotalFulfillmentDays"),
        F.min("TotalFulfillmentDays").alias("MinTotalDays"), F.max("TotalFulfillmentDays").alias("MaxTotalDays"))


@query("Q25_days_by_year", f"""
  SELECT year(OrderDate) AS SourceYear, count(*) AS Orders, {_sql_avg('ProcessingDays', 'AvgProcessingDays')},
    {_sql_avg('TransitDays', 'AvgTransitDays')}, {_sql_avg('TotalFulfillmentDays', 'AvgTotalDays')}
  FROM gen_order_fulfillment WHERE FulfillmentStatus = 'Delivered' GROUP BY year(OrderDate)""",
       ("gen_order_fulfillment",))
def q25(m):
    f = m.get(gen.gen_order_fulfillment).where(F.col("FulfillmentStatus") == "Delivered")
    return f.groupBy(F.year("OrderDate").alias("SourceYear")).agg(
        _cnt().alias("Orders"), _avg("ProcessingDays"), _avg("TransitDays"), _avg("TotalFulfillmentDays"))


# --- fixed values: check labels ----------------------------------------------
Q26_LABELS = ["Cancelled with non-NULL ShipDate (expect 0)", "Non-Cancelled with NULL ShipDate (expect 0)",
              "Delivered/Returned with NULL DeliveryDate (expect 0)", "ShipDate before OrderDate (expect 0)",
              "DeliveryDate before ShipDate (expect 0)", "Orphan SalesOrderNumbers vs FactOnlineSales (expect 0)",
              "Duplicate SalesOrderNumbers (expect 0)"]
# -----------------------------------------------------------------------------


@query("Q26_lifecycle_integrity", sql_metric_rows("""
    SELECT sum(CASE WHEN cancelled AND shipped THEN 1 ELSE 0 END) AS c1, sum(CASE WHEN NOT cancelled AND NOT shipped THEN 1 ELSE 0 END) AS c2,
      sum(CASE WHEN ended AND DeliveryDate IS NULL THEN 1 ELSE 0 END) AS c3, sum(CASE WHEN ShipDate < OrderDate THEN 1 ELSE 0 END) AS c4,
      sum(CASE WHEN DeliveryDate < ShipDate THEN 1 ELSE 0 END) AS c5, sum(CASE WHEN known IS NULL THEN 1 ELSE 0 END) AS c6,
      count(*) - count(DISTINCT SalesOrderNumber) AS c7
    FROM (SELECT g.*, s.known, g.FulfillmentStatus = 'Cancelled' AS cancelled, g.ShipDate IS NOT NULL AS shipped,
            g.FulfillmentStatus IN ('Delivered', 'Returned') AS ended
          FROM gen_order_fulfillment g LEFT JOIN (SELECT SalesOrderNumber, count(*) AS known FROM fact_online_sales GROUP BY 1) s
          USING (SalesOrderNumber)) x""",
    [(label, f"c{i + 1}") for i, label in enumerate(Q26_LABELS)], "Check"), ("gen_order_fulfillment", "fact_online_sales"))
def q26(m):
    """Lifecycle rules in one pass; orders are looked up in the lines' distinct numbers."""
    f = missing_in(m.get(gen.gen_order_fulfillment), m.order_lines.select("SalesOrderNumber").distinct(), "SalesOrderNumber", "orphan")
    st, shipped = F.col("FulfillmentStatus"), F.col("ShipDate").isNotNull()
    rules = [(st == "Cancelled") & shipped, (st != "Cancelled") & ~shipped,
             st.isin("Delivered", "Returned") & F.col("DeliveryDate").isNull(), F.col("ShipDate") < F.col("OrderDate"),
             F.col("DeliveryDate") < F.col("ShipDate"), F.col("orphan")]
    row = f.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules)],
                (_cnt() - F.countDistinct("SalesOrderNumber")).alias("c6"))
    return metric_rows(row, [(label, F.col(f"c{i}")) for i, label in enumerate(Q26_LABELS)], "Check", "Value")


@query("Q27_null_audit", """
  SELECT count(*) FILTER (WHERE ShipDate IS NULL) AS NullShipDate,
    count(*) FILTER (WHERE DeliveryDate IS NULL) AS NullDeliveryDate,
    count(*) FILTER (WHERE ProcessingDays IS NULL) AS NullProcessingDays,
    count(*) FILTER (WHERE TransitDays IS NULL) AS NullTransitDays,
    count(*) FILTER (WHERE TotalFulfillmentDays IS NULL) AS NullTotalFulfilmentDays,
    count(*) FILTER (WHERE FulfillmentStatus = 'Cancelled') AS CancelledOrders,
    count(*) FILTER (WHERE FulfillmentStatus = 'Shipped') AS ShippedOrders
  FROM gen_order_fulfillment""", ("gen_order_fulfillment",))
def q27(m):
    f = m.get(gen.gen_order_fulfillment)
    return f.agg(
        F.count_if(F.col("ShipDate").isNull()).alias("NullShipDate"),
        F.count_if(F.col("DeliveryDate").isNull()).alias("NullDeliveryDate"),
        F.count_if(F.col("ProcessingDays").isNull()).alias("NullProcessingDays"),
        F.count_if(F.col("TransitDays").isNull()).alias("NullTransitDays"),
        F.count_if(F.col("TotalFulfillmentDays").isNull()).alias("NullTotalFulfilmentDays"),
        F.count_if(F.col("FulfillmentStatus") == "Cancelled").alias("CancelledOrders"),
        F.count_if(F.col("FulfillmentStatus") == "Shipped").alias("ShippedOrders"),
    )


@query("Q69_sla_by_tier", """
  SELECT SLAStatus, FulfillmentTier, count(*) AS OrderCount, CAST(sum(IsOnTime) AS BIGINT) AS OnTimeOrders,
    count(*) FILTER (WHERE ShipDate IS NULL) AS NullShipDates, count(*) FILTER (WHERE DeliveryDate IS NULL) AS NullDeliveryDates
  FROM v_order_fulfillment GROUP BY SLAStatus, FulfillmentTier""", ("v_order_fulfillment",))
def q69(m):
    v = m.get(v_order_fulfillment)
    return v.groupBy("SLAStatus", "FulfillmentTier").agg(
        _cnt().alias("OrderCount"), F.sum("IsOnTime").cast("long").alias("OnTimeOrders"),
        F.count_if(F.col("ShipDate").isNull()).alias("NullShipDates"),
        F.count_if(F.col("DeliveryDate").isNull()).alias("NullDeliveryDates"))
