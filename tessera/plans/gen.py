"""Synthesis pipelines P1-P7: derive new tables from the sales facts.

Random draws of the reference are replaced by deterministic hash noise
(``tessera.functions.draw``) so reruns, retries and the oracle agree.
Each function carries ``gen_table`` so a build can persist it
(:mod:`tessera.plans.build`) and later reads reuse the files.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, draw, noise, pad, ratio
from tessera.operators import argmax_key
from tessera.oracle.adapter_sql import draw as sdraw
from tessera.oracle.adapter_sql import noise as snoise
from tessera.oracle.adapter_sql import ratio as sratio
from tessera.oracle.adapter_sql import register


def gen_table(name: str):
    def deco(fn):
        fn.gen_table = name
        return fn

    return deco


def _bands_ge(x: Column, cuts: list[tuple[float, float]], other: float) -> Column:
    e = F.lit(float(other))
    for lim, v in reversed(cuts):
        e = F.when(x >= lim, F.lit(float(v))).otherwise(e)
    return e


def _bands_lt(x: Column, cuts: list[tuple[float, float]], other: float) -> Column:
    e = F.lit(float(other))
    for lim, v in reversed(cuts):
        e = F.when(x < lim, F.lit(float(v))).otherwise(e)
    return e


def _bands_gt(x: Column, cuts: list[tuple[float, float]], other: float) -> Column:
    e = F.lit(float(other))
    for lim, v in reversed(cuts):
        e = F.when(x > lim, F.lit(float(v))).otherwise(e)
    return e


def _sql_bands(x: str, op: str, cuts, other) -> str:
    whens = " ".join(f"WHEN {x} {op} {lim} THEN CAST({v} AS DOUBLE)" for lim, v in cuts)
    return f"(CASE {whens} ELSE CAST({other} AS DOUBLE) END)" if whens else f"CAST({other} AS DOUBLE)"


def _sql_map(x: str, mapping: dict[str, float], other: float) -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN CAST({v} AS DOUBLE)" for k, v in mapping.items())
    return f"(CASE {whens} ELSE CAST({other} AS DOUBLE) END)"


def _map(x: Column, mapping: dict[str, float], other: float) -> Column:
    e = F.lit(float(other))
    for k, v in reversed(list(mapping.items())):
        e = F.when(x == k, F.lit(float(v))).otherwise(e)
    return e


def _noise_factor(salt: str, *keys) -> Column:
    """0.5 + (0..999)/1000, the reference's per-candidate random multiplier."""
    return F.lit(0.5) + draw(salt, 1000, *keys) / 1000.0


def _sql_noise_factor(salt: str, *keys: str) -> str:
    return f"(CAST(0.5 AS DOUBLE) + {sdraw(salt, 1000, *keys)} / CAST(1000.0 AS DOUBLE))"


def _year_progress(year: Column, lo: Column, hi: Column) -> Column:
    """(year - min) / (max - min); 0.5 when the data spans one year."""
    return F.coalesce((year - lo).cast("double") / F.nullif(hi - lo, F.lit(0)).cast("double"), F.lit(0.5))


def _sql_year_progress(year: str, lo: str, hi: str) -> str:
    return f"coalesce(CAST({year} - {lo} AS DOUBLE) / CAST(nullif({hi} - {lo}, 0) AS DOUBLE), 0.5)"


# =============================================================================
# P1  CustomerAcquisition - best of 7 channels per customer
# =============================================================================
# --- fixed values: channel scoring weights (channel key 1..7) ---------------
CH_BASE = {1: 18.0, 2: 22.0, 3: 20.0, 4: 12.0, 5: 14.0, 6: 9.0, 7: 10.0}
CH_YEAR_SLOPE = {1: -0.15, 2: 0.12, 3: -0.10, 4: 0.00, 5: -0.05, 6: 0.08, 7: 0.20}
CH_AGE_CUTS = (30, 45, 60)  # age < 30, < 45, < 60, else
CH_AGE = {1: (0.8, 1.0, 1.2, 1.3), 2: (0.9, 1.2, 1.1, 0.9), 3: (1.6, 1.2, 0.7, 0.4), 4: (0.7, 1.0, 1.3, 1.4),
          5: (0.6, 1.0, 1.2, 1.5), 6: (1.1, 1.1, 1.0, 0.9), 7: (1.8, 1.1, 0.6, 0.4)}
CH_INCOME_CUTS = (120000, 70000, 40000)  # income >= 120k, >= 70k, >= 40k, else
CH_INCOME = {1: (0.9, 1.0, 1.1, 1.1), 2: (1.0, 1.3, 1.1, 0.8), 3: (0.7, 0.9, 1.2, 1.5), 4: (0.9, 1.0, 1.2, 1.1),
             5: (1.5, 1.1, 0.9, 0.7), 6: (1.4, 1.1, 0.9, 0.8), 7: (0.5, 0.7, 1.0, 1.9)}
CH_GEO_NAMES = ("North America", "Europe", "Asia")  # then else
CH_GEO = {1: (1.0, 1.4, 0.7, 1.0), 2: (1.4, 1.0, 0.8, 0.9), 3: (1.2, 0.9, 1.6, 1.1), 4: (1.0, 1.3, 0.8, 1.0),
          5: (1.1, 1.0, 0.9, 1.2), 6: (1.0, 1.0, 1.0, 1.2), 7: (0.8, 0.6, 1.9, 1.1)}
# -----------------------------------------------------------------------------


def _exact_age(birth: Column, at: Column) -> Column:
    """Whole years: year difference, minus one if the birthday falls later that year."""
    n = F.year(at) - F.year(birth)
    return n - F.when(F.add_months(birth, n * 12) > at, 1).otherwise(0)


def _sql_exact_age(birth: str, at: str) -> str:
    n = f"(year({at}) - year({birth}))"
    return f"({n} - CASE WHEN CAST({birth} + to_years(CAST({n} AS INTEGER)) AS DATE) > {at} THEN 1 ELSE 0 END)"


def _p1_profile(m) -> DataFrame:
    buyers = m.dim_customer.where((F.col("CustomerType") == "Person") & F.col("DateFirstPurchase").isNotNull())
    c = buyers.where(F.col("BirthDate").isNotNull())
    yrs = buyers.agg(F.min(F.year("DateFirstPurchase")).alias("lo"), F.max(F.year("DateFirstPurchase")).alias("hi"))
    c = c.join(m.dim_geography.select("GeographyKey", "ContinentName"), "GeographyKey", "left")
    c = c.crossJoin(F.broadcast(yrs))  # one-row scalar (S4)
    return c.select(
        "CustomerKey",
        F.col("DateFirstPurchase").alias("AcquisitionDate"),
        _exact_age(F.col("BirthDate"), F.col("DateFirstPurchase")).alias("age"),
        F.col("YearlyIncome").alias("income"),
        F.coalesce("ContinentName", F.lit("Unknown")).alias("continent"),
        _year_progress(F.year("DateFirstPurchase"), F.col("lo"), F.col("hi")).alias("yp"),
    )


def _p1_score(k: int) -> Column:
    age = _bands_lt(F.col("age"), list(zip(CH_AGE_CUTS, CH_AGE[k][:3])), CH_AGE[k][3])
    inc = _bands_ge(F.col("income"), list(zip(CH_INCOME_CUTS, CH_INCOME[k][:3])), CH_INCOME[k][3])
    geo = _map(F.col("continent"), dict(zip(CH_GEO_NAMES, CH_GEO[k][:3])), CH_GEO[k][3])
    year = F.lit(1.0) + F.lit(CH_YEAR_SLOPE[k]) * F.col("yp")
    return F.lit(CH_BASE[k]) * year * age * inc * geo * _noise_factor("acq", "CustomerKey", F.lit(k))


@gen_table("customer_acquisition")
def gen_customer_acquisition(m) -> DataFrame:
    """One acquisition channel per qualifying Person customer (argmax of 7 scores)."""
    p = _p1_profile(m)
    return p.select(
        F.col("CustomerKey"),
        argmax_key({k: _p1_score(k) for k in CH_BASE}).alias("AcquisitionChannelKey"),
        F.col("AcquisitionDate"),
    )


def _sql_p1_score(k: int) -> str:
    age = _sql_bands("age", "<", list(zip(CH_AGE_CUTS, CH_AGE[k][:3])), CH_AGE[k][3])
    inc = _sql_bands("income", ">=", list(zip(CH_INCOME_CUTS, CH_INCOME[k][:3])), CH_INCOME[k][3])
    geo = _sql_map("continent", dict(zip(CH_GEO_NAMES, CH_GEO[k][:3])), CH_GEO[k][3])
    year = f"(CAST(1.0 AS DOUBLE) + CAST({CH_YEAR_SLOPE[k]} AS DOUBLE) * yp)"
    return (f"CAST({CH_BASE[k]} AS DOUBLE) * {year} * {age} * {inc} * {geo} * "
            f"{_sql_noise_factor('acq', 'CustomerKey', str(k))}")


register("gen_customer_acquisition", f"""
  SELECT CustomerKey, AcquisitionChannelKey, AcquisitionDate FROM (
    SELECT CustomerKey, AcquisitionDate, k AS AcquisitionChannelKey,
      row_number() OVER (PARTITION BY CustomerKey ORDER BY score DESC, k) AS rk
    FROM (SELECT p.*, ch.k,
            CASE ch.k {' '.join(f'WHEN {k} THEN {_sql_p1_score(k)}' for k in CH_BASE)} END AS score
          FROM (SELECT c.CustomerKey, c.DateFirstPurchase AS AcquisitionDate,
                  {_sql_exact_age('c.BirthDate', 'c.DateFirstPurchase')} AS age,
                  c.YearlyIncome AS income, coalesce(g.ContinentName, 'Unknown') AS continent,
                  {_sql_year_progress('year(c.DateFirstPurchase)', 'y.lo', 'y.hi')} AS yp
                FROM dim_customer c LEFT JOIN dim_geography g ON c.GeographyKey = g.GeographyKey
                CROSS JOIN (SELECT min(year(DateFirstPurchase)) AS lo, max(year(DateFirstPurchase)) AS hi
                            FROM dim_customer WHERE CustomerType = 'Person' AND DateFirstPurchase IS NOT NULL) y
                WHERE c.CustomerType = 'Person' AND c.DateFirstPurchase IS NOT NULL AND c.BirthDate IS NOT NULL) p
          CROSS JOIN (SELECT unnest(range(1, 8)) AS k) ch) s) r
  WHERE rk = 1""", ("dim_customer", "dim_geography"))


# =============================================================================
# P2  OrderPayment - best of 7 payment methods per order
# =============================================================================
# --- fixed values: payment scoring weights (method key 1..7) ----------------
PM_GEO_BASE = {
    "North America": (40.0, 15.0, 18.0, 5.0, 7.0, 7.0, 8.0),
    "Europe": (22.0, 22.0, 15.0, 20.0, 5.0, 6.0, 10.0),
    "Asia": (20.0, 18.0, 12.0, 8.0, 30.0, 7.0, 5.0),
}
PM_GEO_BASE_ELSE = (20.0, 15.0, 10.0, 8.0, 35.0, 9.0, 3.0)
# time factor = a + b * YearProgress
PM_TIME = {1: (1.10, -0.10), 2: (1.00, 0.0), 3: (1.10, -0.20), 4: (1.00, -0.10), 5: (1.20, -0.40),
           6: (0.90, 0.20), 7: (0.70, 0.60)}
# order-value factor: [(strictly greater than, factor), ...], else
PM_VALUE = {1: ([(500, 1.30), (100, 1.10)], 0.90), 2: ([], 1.00), 3: ([(500, 0.80)], 1.10),
            4: ([(500, 1.50), (200, 1.20)], 0.60), 5: ([(300, 0.40), (100, 0.70)], 1.30),
            6: ([(500, 0.50), (200, 0.80)], 1.30), 7: ([(500, 1.20), (100, 1.40)], 0.80)}
# -----------------------------------------------------------------------------


def order_number(order_key) -> Column:
    """SalesOrderNumber of a numeric order key ('SO' + at least 10 digits)."""
    return F.concat(F.lit("SO"), pad(order_key, 10))


def order_totals(m) -> DataFrame:
    """Order grain: date, customer and the sums of the order's lines.

    The lines are summed by order first (a hot order is combined map-side) and
    the orders joined to the sums, which are already dealt by order. Numeric
    aggregates only, so it stays a hash aggregate."""
    sums = m.order_lines.groupBy("OrderKey").agg(
        F.sum("SalesAmount").alias("amt"), F.sum("ReturnAmount").alias("ra"), F.sum("DiscountAmount").alias("da"),
        F.sum("TotalCost").alias("cost"), F.sum("SalesQuantity").alias("sq"), F.sum("ReturnQuantity").alias("rq"),
        F.count(F.lit(1)).alias("ItemCount"), F.min("StoreKey").alias("StoreKey"))
    return sums.join(m.order_heads, "OrderKey")


def order_profile(m) -> DataFrame:
    """Order grain: date, value, item count, customer; the order number is
    derived from the key afterwards."""
    return order_totals(m).select("OrderKey", order_number("OrderKey").alias("SalesOrderNumber"), "OrderDate",
                                  F.col("amt").cast("decimal(19,4)").alias("OrderValue"), "ItemCount", "CustomerKey", "StoreKey")


def date_bounds(m, orders: DataFrame) -> DataFrame:
    """One row ``lo, hi, maxd``: first and last year and last date of
    ``orders`` (the reference's scalars, computed once before the CTE chain).

    ``orders`` is the frame that the pipeline goes on with: the extremes carry
    all its columns, so nothing of it is pruned here and Spark runs the lines'
    sums once and reuses their exchange. A configured ``max_date`` replaces the
    last date."""
    every = F.struct("OrderDate", *[c for c in orders.columns if c != "OrderDate"])
    f = orders.agg(F.min(every).alias("first"), F.max(every).alias("last"))
    last = F.col("last.OrderDate") if m.cfg.max_date is None else F.lit(m.cfg.max_date)
    return f.select(F.year("first.OrderDate").alias("lo"), F.year("last.OrderDate").alias("hi"), last.alias("maxd"))


def _p2_score(k: int) -> Column:
    base = _map(F.col("continent"), {g: v[k - 1] for g, v in PM_GEO_BASE.items()}, PM_GEO_BASE_ELSE[k - 1])
    a, b = PM_TIME[k]
    time = F.lit(a) + F.lit(b) * F.col("yp")
    cuts, other = PM_VALUE[k]
    value = _bands_gt(F.col("OrderValue"), cuts, other)
    return base * time * value * _noise_factor("pay", "OrderKey", F.lit(k))


@gen_table("order_payment")
def gen_order_payment(m) -> DataFrame:
    """One payment method per order (argmax of 7 scores)."""
    op = order_totals(m).select("OrderKey", "OrderDate", "amt", "CustomerKey")
    yrs = date_bounds(m, op).select("lo", "hi")
    c = m.dim_customer.select("CustomerKey", "GeographyKey")
    g = m.dim_geography.select("GeographyKey", "ContinentName")
    x = op.join(c, "CustomerKey").join(g, "GeographyKey", "left").crossJoin(F.broadcast(yrs))
    x = x.select(
        "OrderKey", order_number("OrderKey").alias("SalesOrderNumber"), "OrderDate", F.col("amt").cast("decimal(19,4)").alias("OrderValue"),
        F.coalesce("ContinentName", F.lit("Unknown")).alias("continent"),
        _year_progress(F.year("OrderDate"), F.col("lo"), F.col("hi")).alias("yp"),
    )
    return x.select(
        "SalesOrderNumber",
        argmax_key({k: _p2_score(k) for k in PM_TIME}).alias("PaymentMethodKey"),
        date_key("OrderDate").alias("OrderDateKey"),
        "OrderValue",
    )


def _sql_p2_score(k: int) -> str:
    base = _sql_map("continent", {g: v[k - 1] for g, v in PM_GEO_BASE.items()}, PM_GEO_BASE_ELSE[k - 1])
    a, b = PM_TIME[k]
    time = f"(CAST({a} AS DOUBLE) + CAST({b} AS DOUBLE) * yp)"
    cuts, other = PM_VALUE[k]
    value = _sql_bands("OrderValue", ">", cuts, other)
    return f"{base} * {time} * {value} * {_sql_noise_factor('pay', 'OrderKey', str(k))}"


register("order_profile", """
  SELECT OrderKey, any_value(SalesOrderNumber) AS SalesOrderNumber, CAST(min(DateKey) AS DATE) AS OrderDate,
    CAST(sum(SalesAmount) AS DECIMAL(19,4)) AS OrderValue, count(*) AS ItemCount,
    min(CustomerKey) AS CustomerKey, min(StoreKey) AS StoreKey
  FROM fact_online_sales GROUP BY OrderKey""", ("fact_online_sales",))
register("gen_order_payment", f"""
  SELECT SalesOrderNumber, PaymentMethodKey, OrderDateKey, OrderValue FROM (
    SELECT SalesOrderNumber, OrderValue, k AS PaymentMethodKey,
      CAST(year(OrderDate) * 10000 + month(OrderDate) * 100 + day(OrderDate) AS INTEGER) AS OrderDateKey,
      row_number() OVER (PARTITION BY SalesOrderNumber ORDER BY score DESC, k) AS rk
    FROM (SELECT p.*, pm.k,
            CASE pm.k {' '.join(f'WHEN {k} THEN {_sql_p2_score(k)}' for k in PM_TIME)} END AS score
          FROM (SELECT op.OrderKey, op.SalesOrderNumber, op.OrderDate, op.OrderValue,
                  coalesce(g.ContinentName, 'Unknown') AS continent,
                  {_sql_year_progress('year(op.OrderDate)', 'y.lo', 'y.hi')} AS yp
                FROM order_profile op JOIN dim_customer c ON op.CustomerKey = c.CustomerKey
                LEFT JOIN dim_geography g ON c.GeographyKey = g.GeographyKey
                CROSS JOIN (SELECT min(year(OrderDate)) AS lo, max(year(OrderDate)) AS hi FROM order_profile) y) p
          CROSS JOIN (SELECT unnest(range(1, 8)) AS k) pm) s) r
  WHERE rk = 1""", ("order_profile", "dim_customer", "dim_geography"))


# =============================================================================
# P3  OrderFulfillment - order lifecycle (ship / deliver / cancel / return)
# =============================================================================
# --- fixed values ------------------------------------------------------------
FUL_RECENT_DAYS = 21                      # orders this close to the max date are still open
FUL_METHOD_CUTS = [(10, "Overnight"), (40, "Express")]  # shipping seed < cut, else Standard
FUL_GEO = {"Domestic": 0.70, "Continental": 1.00, "International": 1.60}
FUL_PROC_DECAY = 0.30                     # processing speeds up by 30 % over the years
FUL_TRANSIT_BASE = {"Standard": (5, 8), "Express": (2, 4)}  # base days + seed range
FUL_OVERNIGHT_INTL = 1.5
FUL_STATUS_CUTS = [(2, "Cancelled"), (3, "Returned")]   # status seed < cut, else Delivered
# -----------------------------------------------------------------------------


def _geo_ranked(m) -> DataFrame:
    """Geography with integer ranks of country and continent names (25 rows), so
    per-order MIN(name) becomes a hash-aggregated MIN(rank)."""
    from pyspark.sql import Window

    g = m.dim_geography.select("GeographyKey", "RegionCountryName", "ContinentName")
    return g.select("GeographyKey", "RegionCountryName", "ContinentName",
                    F.dense_rank().over(Window.orderBy("RegionCountryName")).alias("country_rank"),
                    F.dense_rank().over(Window.orderBy("ContinentName")).alias("continent_rank"))


def _fulfilment_base(m) -> DataFrame:
    geo = F.broadcast(_geo_ranked(m))  # fixed-size
    # an order's different stores first, so that no line is shuffled by store
    f = m.order_lines.select("OrderKey", "StoreKey").distinct()
    # bare store dim first (its size estimate stays small), then the 25-row geography
    pairs = f.join(m.dim_store.select("StoreKey", "GeographyKey"), "StoreKey", "left") \
        .join(geo.select("GeographyKey", "country_rank", "continent_rank"), "GeographyKey", "left")
    ob = pairs.groupBy("OrderKey").agg(F.min("country_rank").alias("scr"), F.min("continent_rank").alias("skr"))
    ob = ob.join(m.order_heads, "OrderKey")
    bounds = date_bounds(m, ob)
    names_c = geo.select(F.col("country_rank").alias("scr"), F.col("RegionCountryName").alias("sc")).distinct()
    names_k = geo.select(F.col("continent_rank").alias("skr"), F.col("ContinentName").alias("sk")).distinct()
    ob = ob.join(F.broadcast(names_c), "scr", "left").join(F.broadcast(names_k), "skr", "left")
    ob = ob.withColumn("SalesOrderNumber", order_number("OrderKey"))
    ob = ob.join(m.dim_customer.select("CustomerKey", "GeographyKey"), "CustomerKey").join(
        m.dim_geography.select("GeographyKey", F.col("RegionCountryName").alias("cc"),
                               F.col("ContinentName").alias("ck")), "GeographyKey", "left")
    ob = ob.crossJoin(F.broadcast(bounds))
    k = "OrderKey"
    return ob.select(
        "SalesOrderNumber", "OrderDate",
        F.coalesce("cc", F.lit("Unknown")).alias("cc"), F.coalesce("ck", F.lit("Unknown")).alias("ck"),
        F.coalesce("sc", F.lit("Unknown")).alias("sc"), F.coalesce("sk", F.lit("Unknown")).alias("sk"),
        _year_progress(F.year("OrderDate"), F.col("lo"), F.col("hi")).alias("yp"),
        (F.col("OrderDate") >= F.date_sub("maxd", FUL_RECENT_DAYS)).alias("recent"),
        draw("ful_ship", 100, k).alias("s_ship"), draw("ful_status", 100, k).alias("s_status"),
        draw("ful_bin", 2, k).alias("s_bin"), draw("ful_pstd", 3, k).alias("s_pstd"),
        draw("ful_pexp", 2, k).alias("s_pexp"), draw("ful_tstd", 8, k).alias("s_tstd"),
        draw("ful_texp", 4, k).alias("s_texp"),
    )


@gen_table("order_fulfillment")
def gen_order_fulfillment(m) -> DataFrame:
    """One lifecycle row per order, NULL dates for unshipped/undelivered."""
    b = _fulfilment_base(m)
    method = F.lit("Standard")
    for cut, name in reversed(FUL_METHOD_CUTS):
        method = F.when(F.col("s_ship") < cut, F.lit(name)).otherwise(method)
    geo = (F.when(F.col("cc") == F.col("sc"), F.lit(FUL_GEO["Domestic"]))
           .when(F.col("ck") == F.col("sk"), F.lit(FUL_GEO["Continental"]))
           .otherwise(F.lit(FUL_GEO["International"])))
    b = b.withColumn("method", method).withColumn("geo", geo)
    decay = F.lit(1.0) - F.col("yp") * FUL_PROC_DECAY

    def rnd(x):
        return F.round(x, 0).cast("int")

    proc = (F.when(F.col("method") == "Standard", F.greatest(F.lit(1), rnd((1 + F.col("s_pstd")).cast("double") * decay)))
            .when(F.col("method") == "Express", F.greatest(F.lit(1), rnd((1 + F.col("s_pexp")).cast("double") * decay)))
            .otherwise(F.greatest(F.lit(0), rnd(F.col("s_bin").cast("double") * decay))))
    std_b, std_n = FUL_TRANSIT_BASE["Standard"]
    exp_b, exp_n = FUL_TRANSIT_BASE["Express"]
    transit = (F.when(F.col("method") == "Standard", F.ceil((std_b + F.col("s_tstd")).cast("double") * F.col("geo")))
               .when(F.col("method") == "Express", F.ceil((exp_b + F.col("s_texp")).cast("double") * F.col("geo")))
               .otherwise(F.ceil((1 + F.col("s_bin")).cast("double")
                                 * F.when(F.col("geo") > 1.0, F.lit(FUL_OVERNIGHT_INTL)).otherwise(F.col("geo"))))
               ).cast("int")
    status = F.lit("Delivered")
    for cut, name in reversed(FUL_STATUS_CUTS):
        status = F.when(F.col("s_status") < cut, F.lit(name)).otherwise(status)
    status = F.when(F.col("recent"), F.when(F.col("s_bin") == 0, "Shipped").otherwise("Delivered")).otherwise(status)
    b = b.withColumn("proc", proc).withColumn("transit", transit).withColumn("status", status)
    st = F.col("status")
    cancelled = st == "Cancelled"
    undelivered = st.isin("Cancelled", "Shipped")
    return b.select(
        "SalesOrderNumber", "OrderDate",
        F.when(~cancelled, F.date_add("OrderDate", F.col("proc"))).alias("ShipDate"),
        F.when(~undelivered, F.date_add("OrderDate", F.col("proc") + F.col("transit"))).alias("DeliveryDate"),
        st.alias("FulfillmentStatus"),
        F.col("method").alias("ShippingMethod"),
        F.when(~cancelled, F.col("proc")).alias("ProcessingDays"),
        F.when(~undelivered, F.col("transit")).alias("TransitDays"),
        F.when(st.isin("Delivered", "Returned"), F.col("proc") + F.col("transit")).alias("TotalFulfillmentDays"),
    )


_K = "OrderKey"
register("gen_order_fulfillment", f"""
  SELECT SalesOrderNumber, OrderDate,
    CASE WHEN status <> 'Cancelled' THEN CAST(OrderDate + proc AS DATE) END AS ShipDate,
    CASE WHEN status NOT IN ('Cancelled', 'Shipped') THEN CAST(OrderDate + proc + transit AS DATE) END AS DeliveryDate,
    status AS FulfillmentStatus, method AS ShippingMethod,
    CASE WHEN status <> 'Cancelled' THEN proc END AS ProcessingDays,
    CASE WHEN status NOT IN ('Cancelled', 'Shipped') THEN transit END AS TransitDays,
    CASE WHEN status IN ('Delivered', 'Returned') THEN proc + transit END AS TotalFulfillmentDays
  FROM (SELECT *,
      CASE method
        WHEN 'Standard' THEN greatest(1, CAST(round(CAST(1 + s_pstd AS DOUBLE) * (1.0 - yp * {FUL_PROC_DECAY})) AS INTEGER))
        WHEN 'Express' THEN greatest(1, CAST(round(CAST(1 + s_pexp AS DOUBLE) * (1.0 - yp * {FUL_PROC_DECAY})) AS INTEGER))
        ELSE greatest(0, CAST(round(CAST(s_bin AS DOUBLE) * (1.0 - yp * {FUL_PROC_DECAY})) AS INTEGER)) END AS proc,
      CAST(CASE method
        WHEN 'Standard' THEN ceil(CAST({FUL_TRANSIT_BASE['Standard'][0]} + s_tstd AS DOUBLE) * geo)
        WHEN 'Express' THEN ceil(CAST({FUL_TRANSIT_BASE['Express'][0]} + s_texp AS DOUBLE) * geo)
        ELSE ceil(CAST(1 + s_bin AS DOUBLE) * CASE WHEN geo > 1.0 THEN CAST({FUL_OVERNIGHT_INTL} AS DOUBLE) ELSE geo END) END AS INTEGER) AS transit,
      CASE WHEN recent THEN CASE WHEN s_bin = 0 THEN 'Shipped' ELSE 'Delivered' END
           WHEN s_status < 2 THEN 'Cancelled' WHEN s_status < 3 THEN 'Returned' ELSE 'Delivered' END AS status
    FROM (SELECT *,
        CASE WHEN s_ship < 10 THEN 'Overnight' WHEN s_ship < 40 THEN 'Express' ELSE 'Standard' END AS method,
        CASE WHEN cc = sc THEN CAST({FUL_GEO['Domestic']} AS DOUBLE) WHEN ck = sk THEN CAST({FUL_GEO['Continental']} AS DOUBLE)
             ELSE CAST({FUL_GEO['International']} AS DOUBLE) END AS geo
      FROM (SELECT SalesOrderNumber, OrderDate,
          coalesce(cc, 'Unknown') AS cc, coalesce(ck, 'Unknown') AS ck, coalesce(sc, 'Unknown') AS sc, coalesce(sk, 'Unknown') AS sk,
          {_sql_year_progress('year(OrderDate)', 'y.lo', 'y.hi')} AS yp,
          OrderDate >= CAST(y.maxd - INTERVAL {FUL_RECENT_DAYS} DAY AS DATE) AS recent,
          {sdraw('ful_ship', 100, _K)} AS s_ship, {sdraw('ful_status', 100, _K)} AS s_status,
          {sdraw('ful_bin', 2, _K)} AS s_bin, {sdraw('ful_pstd', 3, _K)} AS s_pstd, {sdraw('ful_pexp', 2, _K)} AS s_pexp,
          {sdraw('ful_tstd', 8, _K)} AS s_tstd, {sdraw('ful_texp', 4, _K)} AS s_texp
        FROM (SELECT o.*, cg.RegionCountryName AS cc, cg.ContinentName AS ck
              FROM (SELECT f.OrderKey, any_value(f.SalesOrderNumber) AS SalesOrderNumber, CAST(min(f.DateKey) AS DATE) AS OrderDate,
                      min(f.CustomerKey) AS CustomerKey, min(sg.RegionCountryName) AS sc, min(sg.ContinentName) AS sk
                    FROM fact_online_sales f LEFT JOIN dim_store s ON f.StoreKey = s.StoreKey
                    LEFT JOIN dim_geography sg ON s.GeographyKey = sg.GeographyKey GROUP BY f.OrderKey) o
              JOIN dim_customer c ON o.CustomerKey = c.CustomerKey
              LEFT JOIN dim_geography cg ON c.GeographyKey = cg.GeographyKey) ob
        CROSS JOIN (SELECT min(year(OrderDate)) AS lo, max(year(OrderDate)) AS hi, max(OrderDate) AS maxd FROM order_profile) y
      ) b) c) d""", ("fact_online_sales", "dim_store", "dim_geography", "dim_customer", "order_profile"))


# =============================================================================
# P6 / P7  Return events (online and physical)
# =============================================================================
# --- fixed values ------------------------------------------------------------
RET_TIER_CUTS = (50, 200)                       # amount < 50 -> tier 1, < 200 -> 2, else 3
ONLINE_LAG = {1: (7, 8), 2: (14, 8), 3: (21, 25)}   # tier -> (base days, noise modulus)
STORE_LAG = {1: (1, 5), 2: (3, 8), 3: (5, 17)}
ONLINE_REFUND_PCT = {1: 90, 2: 85, 3: 80}
STORE_REFUND_PCT = {1: 92, 2: 88, 3: 83}
ONLINE_REASON_SCOPE = ("Both", "Online Only")
STORE_REASON_SCOPE = ("Both",)
# -----------------------------------------------------------------------------


def _eligible_reasons(m, scope) -> DataFrame:
    """Eligible reasons numbered 0..n-1 by key, with n; at most 8 rows."""
    from pyspark.sql import Window

    r = m.ref_return_reason.where(F.col("AppliesTo").isin(*scope)).select("ReturnReasonKey")
    w = Window.orderBy("ReturnReasonKey")
    return r.select("ReturnReasonKey", (F.row_number().over(w) - 1).alias("rn"),
                    F.count(F.lit(1)).over(Window.partitionBy()).alias("n_reasons"))


def _returns(m, lines: DataFrame, keys: tuple[str, ...], salt: str, lag: dict, refund: dict, scope) -> DataFrame:
    """Shared body of P6/P7: narrow map over returned lines + broadcast reason lookup.

    Draws are keyed on the line's order and its number there, so they do not
    move when lines of other orders come or go."""
    amt = F.col("ReturnAmount")
    tier = F.when(amt < RET_TIER_CUTS[0], 1).when(amt < RET_TIER_CUTS[1], 2).otherwise(3)
    na, nb, nc = (noise(f"{salt}_{x}", *keys) for x in "abc")
    lag_days = F.lit(0)
    refunded = F.lit(False)
    for t in (3, 2, 1):
        base, mod = lag[t]
        lag_days = F.when(F.col("tier") == t, F.lit(base) + F.pmod(F.col("na"), F.lit(mod))).otherwise(lag_days)
        refunded = F.when(F.col("tier") == t, F.pmod(F.col("nc"), F.lit(100)) < refund[t]).otherwise(refunded)
    reasons = _eligible_reasons(m, scope)
    n = reasons.agg(F.max("n_reasons").alias("n_reasons"))  # one row
    x = (lines.where((F.col("ReturnQuantity") > 0) & (F.col("ReturnAmount") > 0))
         .withColumn("tier", tier).withColumn("na", na).withColumn("nb", nb).withColumn("nc", nc)
         .crossJoin(F.broadcast(n)))
    x = x.withColumn("rn", F.pmod(F.col("nb"), F.col("n_reasons")))
    x = x.join(F.broadcast(reasons.select("rn", "ReturnReasonKey")), "rn")  # <= 8 rows
    sale = F.col("DateKey").cast("date")
    x = m.with_scalars(x, "max_date").withColumn("lag", lag_days.cast("int")).withColumn("refunded", refunded)
    ret = F.least(F.date_add(sale, F.col("lag")), F.col("max_date"))
    return x.select(
        "*",
        date_key(sale).alias("OriginalSaleDateKey"), sale.alias("OriginalSaleDate"),
        date_key(ret).alias("ReturnDateKey"), ret.alias("ReturnDate"),
        F.col("lag").alias("ReturnLagDays"),
        F.col("refunded").alias("IsRefunded"),
        F.when(F.col("refunded"), F.col("ReturnAmount")).otherwise(F.lit(0).cast("decimal(19,4)"))
        .cast("decimal(19,4)").alias("RefundAmount"),
    )


_RET_COLS = ["OriginalSaleDateKey", "OriginalSaleDate", "ReturnDateKey", "ReturnDate", "ReturnLagDays",
             "ReturnQuantity", "ReturnAmount", "ReturnReasonKey", "IsRefunded", "RefundAmount"]


@gen_table("online_return_events")
def gen_online_returns(m) -> DataFrame:
    """One return event per returned online line (id = the sales line key)."""
    f = m.fact_online_sales.select("OnlineSalesKey", "OrderKey", "SalesOrderNumber", "SalesOrderLineNumber", "CustomerKey",
                                   "ProductKey", "DateKey", "ReturnQuantity", "ReturnAmount")
    x = _returns(m, f, ("OrderKey", "SalesOrderLineNumber"), "oret", ONLINE_LAG, ONLINE_REFUND_PCT, ONLINE_REASON_SCOPE)
    return x.select(F.col("OnlineSalesKey").alias("OnlineReturnEventID"), "SalesOrderNumber",
                    "SalesOrderLineNumber", "CustomerKey", "ProductKey", *_RET_COLS)


@gen_table("physical_return_events")
def gen_store_returns(m) -> DataFrame:
    """One return event per returned store line."""
    f = m.fact_sales.select("SalesKey", "OrderKey", "LineNumber", "StoreKey", "ProductKey", "DateKey", "ReturnQuantity", "ReturnAmount")
    x = _returns(m, f, ("OrderKey", "LineNumber"), "pret", STORE_LAG, STORE_REFUND_PCT, STORE_REASON_SCOPE)
    return x.select(F.col("SalesKey").alias("PhysicalReturnEventID"), F.col("SalesKey").alias("SourceSalesKey"),
                    "StoreKey", "ProductKey", *_RET_COLS)


def _sql_returns(src: str, keys: tuple[str, ...], salt: str, lag: dict, refund: dict, scope, cols: str) -> str:
    na, nb, nc = (snoise(f"{salt}_{x}", *keys) for x in "abc")
    lag_case = "CASE tier " + " ".join(f"WHEN {t} THEN {b} + na % {md}" for t, (b, md) in lag.items()) + " END"
    ref_case = "CASE tier " + " ".join(f"WHEN {t} THEN nc % 100 < {p}" for t, p in refund.items()) + " END"
    scope_sql = ", ".join(f"'{s}'" for s in scope)
    return f"""
  SELECT {cols},
    CAST(year(OriginalSaleDate) * 10000 + month(OriginalSaleDate) * 100 + day(OriginalSaleDate) AS INTEGER) AS OriginalSaleDateKey,
    OriginalSaleDate,
    CAST(year(ReturnDate) * 10000 + month(ReturnDate) * 100 + day(ReturnDate) AS INTEGER) AS ReturnDateKey, ReturnDate,
    lag AS ReturnLagDays, ReturnQuantity, ReturnAmount, ReturnReasonKey, refunded AS IsRefunded,
    CAST(CASE WHEN refunded THEN ReturnAmount ELSE 0 END AS DECIMAL(19,4)) AS RefundAmount
  FROM (SELECT x.*, CAST(DateKey AS DATE) AS OriginalSaleDate,
          least(CAST(CAST(DateKey AS DATE) + lag AS DATE), s.max_date) AS ReturnDate, r.ReturnReasonKey
        FROM (SELECT *, CAST({lag_case} AS INTEGER) AS lag, {ref_case} AS refunded
              FROM (SELECT *, CASE WHEN ReturnAmount < {RET_TIER_CUTS[0]} THEN 1 WHEN ReturnAmount < {RET_TIER_CUTS[1]} THEN 2 ELSE 3 END AS tier,
                      {na} AS na, {nb} AS nb, {nc} AS nc
                    FROM {src} WHERE ReturnQuantity > 0 AND ReturnAmount > 0) t) x
        CROSS JOIN scalars s
        JOIN (SELECT ReturnReasonKey, row_number() OVER (ORDER BY ReturnReasonKey) - 1 AS rn, count(*) OVER () AS n
              FROM ref_return_reason WHERE AppliesTo IN ({scope_sql})) r ON r.rn = x.nb % r.n) y"""


register("gen_online_returns", _sql_returns(
    "fact_online_sales", ("OrderKey", "SalesOrderLineNumber"), "oret", ONLINE_LAG, ONLINE_REFUND_PCT, ONLINE_REASON_SCOPE,
    "OnlineSalesKey AS OnlineReturnEventID, SalesOrderNumber, SalesOrderLineNumber, CustomerKey, ProductKey"),
    ("fact_online_sales", "scalars", "ref_return_reason"))
register("gen_store_returns", _sql_returns(
    "fact_sales", ("OrderKey", "LineNumber"), "pret", STORE_LAG, STORE_REFUND_PCT, STORE_REASON_SCOPE,
    "SalesKey AS PhysicalReturnEventID, SalesKey AS SourceSalesKey, StoreKey, ProductKey"),
    ("fact_sales", "scalars", "ref_return_reason"))


# =============================================================================
# P5  FactCustomerSurvey - behaviour-driven NPS / CSAT responses
# =============================================================================
# --- fixed values ------------------------------------------------------------
SV_FREQ = [(10, "0.25"), (5, "0.20"), (3, "0.15"), (2, "0.10")]        # orders >= n
SV_FREQ_ELSE = "0.05"
SV_RECENCY = [(90, "0.25"), (180, "0.20"), (365, "0.12")]              # days since last < n
SV_RECENCY_ELSE = "0.05"
SV_RETURN_ZERO = "0.25"
SV_RETURN = [(0.05, "0.18"), (0.15, "0.10")]                           # return rate < r
SV_RETURN_ELSE = "0.03"
SV_SPEND = [(5000, "0.25"), (1000, "0.18"), (200, "0.12")]             # spend > s
SV_SPEND_ELSE = "0.07"
SV_SAMPLE = [(10, 30), (5, 25), (2, 20)]                               # orders >= n -> pct surveyed
SV_SAMPLE_ELSE = 15
# trigger: (name, id, base day offset, day noise modulus, min tenure days, min orders)
SV_TRIGGERS = [("Post-Purchase", 1, 7, 8, None, None), ("Quarterly", 2, 180, 30, 200, 2),
               ("Annual", 3, 365, 30, 380, 3)]
SV_POST_FACTOR = 0.85
SV_ANNUAL_FACTOR = (0.90, 200)          # 0.90 + (0..199)/1000
# -----------------------------------------------------------------------------


def customer_behaviour(m) -> DataFrame:
    """Per-customer orders, spend, return rate and purchase span.

    Built from the order grain (one customer per order), so COUNT(DISTINCT
    order) is a plain count and every step is a partial aggregation - a hot
    customer is pre-combined map-side instead of landing in one task."""
    o = order_totals(m)
    b = o.groupBy("CustomerKey").agg(
        F.count(F.lit(1)).alias("TotalOrders"), F.sum("amt").alias("TotalSpend"),
        F.sum("rq").alias("TotalReturnQty"), F.sum("sq").alias("TotalSalesQty"),
        F.max("OrderDate").alias("LastPurchaseDate"), F.min("OrderDate").alias("FirstPurchaseDate"))
    return b.withColumn("ReturnRate", F.when(F.col("TotalSalesQty") > 0,
                                             F.col("TotalReturnQty").cast("double") / F.col("TotalSalesQty"))
                        .otherwise(F.lit(0.0)))


def _dec_bands(x, cuts, other, op):
    e = F.lit(Decimal(other))
    for lim, v in reversed(cuts):
        cond = {"<": x < lim, ">": x > lim, ">=": x >= lim}[op]
        e = F.when(cond, F.lit(Decimal(v))).otherwise(e)
    return e


@gen_table("customer_survey")
def gen_customer_survey(m) -> DataFrame:
    """P5: sampled customers answer up to three surveys (post-purchase, quarterly, annual)."""
    b = customer_behaviour(m).join(
        m.dim_customer.where(F.col("CustomerType") == "Person").select("CustomerKey"), "CustomerKey")
    b = m.with_scalars(b, "max_date")
    since = F.datediff("max_date", "LastPurchaseDate")
    tenure = F.datediff("max_date", "FirstPurchaseDate")
    rr = F.col("ReturnRate")
    ret = F.when(rr == 0, F.lit(Decimal(SV_RETURN_ZERO))).otherwise(_dec_bands(rr, SV_RETURN, SV_RETURN_ELSE, "<"))
    score = (_dec_bands(F.col("TotalOrders"), SV_FREQ, SV_FREQ_ELSE, ">=")
             + _dec_bands(since, SV_RECENCY, SV_RECENCY_ELSE, "<")
             + ret
             + _dec_bands(F.col("TotalSpend"), SV_SPEND, SV_SPEND_ELSE, ">")).cast("double")
    pct = F.lit(SV_SAMPLE_ELSE)
    for n, p in reversed(SV_SAMPLE):
        pct = F.when(F.col("TotalOrders") >= n, F.lit(p)).otherwise(pct)
    s = b.select("CustomerKey", "TotalOrders", "FirstPurchaseDate", "max_date", tenure.alias("tenure"),
                 score.alias("score")).where(draw("sv_sample", 100, "CustomerKey") < pct)
    # one pass over the sampled customers: explode the (up to) three triggers
    trig = F.explode(F.array(*[
        F.struct(F.lit(name).alias("trigger"), F.lit(tid).alias("tid"), F.lit(base).alias("base"),
                 F.lit(mod).alias("mod"))
        for name, tid, base, mod, _, _ in SV_TRIGGERS]))
    x = s.select("*", trig.alias("t")).select("*", "t.*").drop("t")
    keep = F.lit(True)
    for name, _, _, _, min_ten, min_ord in SV_TRIGGERS:
        if min_ten is not None:
            keep = F.when(F.col("trigger") == name, (F.col("tenure") > min_ten) & (F.col("TotalOrders") >= min_ord)) \
                .otherwise(keep)
    x = x.where(keep)
    keys = ("CustomerKey", "tid")
    day = F.col("base") + F.pmod(noise("sv_day", *keys), F.col("mod"))
    sdate = F.least(F.date_add("FirstPurchaseDate", day.cast("int")), F.col("max_date"))
    lo, span = SV_ANNUAL_FACTOR
    adj = (F.when(F.col("tid") == 1, F.col("score") * SV_POST_FACTOR)
           .when(F.col("tid") == 2, F.col("score") * 1.00)
           .otherwise(F.col("score") * (F.lit(lo) + draw("sv_annual", span, *keys) / 1000.0)))
    ns, cs = draw("sv_nps", 100, *keys), draw("sv_csat", 100, *keys)
    nps = (F.when(F.col("adj") >= 0.80, 8 + F.when(F.col("ns") < 55, 2).when(F.col("ns") < 85, 1).otherwise(0))
           .when(F.col("adj") >= 0.60, 6 + F.when(F.col("ns") < 50, 2).when(F.col("ns") < 85, 1).otherwise(0))
           .when(F.col("adj") >= 0.40, 5 + draw("sv_nps_lo", 3, *keys))
           .when(F.col("adj") >= 0.25, 3 + draw("sv_nps_lo", 4, *keys))
           .otherwise(draw("sv_nps_lo", 5, *keys))).cast("int")
    x = x.select("CustomerKey", "tid", "trigger", sdate.alias("SurveyDate"), adj.alias("adj"),
                 ns.alias("ns"), cs.alias("cs"))
    x = x.withColumn("NPSScore", nps)
    n, c = F.col("NPSScore"), F.col("cs")
    csat = (F.when(n >= 9, F.when(c < 60, 5).when(c < 90, 4).otherwise(3))
            .when(n >= 7, F.when(c < 40, 4).when(c < 80, 3).otherwise(2))
            .when(n >= 4, F.when(c < 50, 3).when(c < 80, 2).otherwise(1))
            .otherwise(F.when(c < 55, 1).otherwise(2))).cast("int")
    x = x.withColumn("CSATScore", csat)
    return x.select(
        (F.col("CustomerKey").cast("long") * 10 + F.col("tid")).alias("SurveyResponseID"),
        "CustomerKey",
        date_key("SurveyDate").alias("SurveyDateKey"), "SurveyDate",
        "NPSScore",
        F.when(n >= 9, "Promoter").when(n >= 7, "Passive").otherwise("Detractor").alias("NPSCategory"),
        "CSATScore",
        F.when(F.col("CSATScore") >= 4, "Satisfied").when(F.col("CSATScore") == 3, "Neutral")
        .otherwise("Dissatisfied").alias("CSATCategory"),
        (n >= 9).alias("WouldRecommend"),
        F.col("trigger").alias("SurveyTrigger"),
    )


def _sql_dec_bands(x, cuts, other, op):
    return "CASE " + " ".join(f"WHEN {x} {op} {lim} THEN {v}" for lim, v in cuts) + f" ELSE {other} END"


_SK = ("CustomerKey", "tid")
register("customer_behaviour", """
  SELECT CustomerKey, count(*) AS TotalOrders, sum(amt) AS TotalSpend, sum(rq) AS TotalReturnQty, sum(sq) AS TotalSalesQty,
    max(last) AS LastPurchaseDate, min(first) AS FirstPurchaseDate,
    CASE WHEN sum(sq) > 0 THEN CAST(sum(rq) AS DOUBLE) / CAST(sum(sq) AS DOUBLE) ELSE 0.0 END AS ReturnRate
  FROM (SELECT OrderKey, min(CustomerKey) AS CustomerKey, sum(SalesAmount) AS amt, sum(ReturnQuantity) AS rq,
          sum(SalesQuantity) AS sq, CAST(min(DateKey) AS DATE) AS first, CAST(max(DateKey) AS DATE) AS last
        FROM fact_online_sales GROUP BY OrderKey) o
  GROUP BY CustomerKey""", ("fact_online_sales",))
register("gen_customer_survey", f"""
  SELECT CAST(CustomerKey AS BIGINT) * 10 + tid AS SurveyResponseID, CustomerKey,
    CAST(year(SurveyDate) * 10000 + month(SurveyDate) * 100 + day(SurveyDate) AS INTEGER) AS SurveyDateKey, SurveyDate,
    NPSScore, CASE WHEN NPSScore >= 9 THEN 'Promoter' WHEN NPSScore >= 7 THEN 'Passive' ELSE 'Detractor' END AS NPSCategory,
    CSATScore, CASE WHEN CSATScore >= 4 THEN 'Satisfied' WHEN CSATScore = 3 THEN 'Neutral' ELSE 'Dissatisfied' END AS CSATCategory,
    NPSScore >= 9 AS WouldRecommend, trigger AS SurveyTrigger
  FROM (SELECT *, CAST(CASE WHEN NPSScore >= 9 THEN CASE WHEN cs < 60 THEN 5 WHEN cs < 90 THEN 4 ELSE 3 END
                            WHEN NPSScore >= 7 THEN CASE WHEN cs < 40 THEN 4 WHEN cs < 80 THEN 3 ELSE 2 END
                            WHEN NPSScore >= 4 THEN CASE WHEN cs < 50 THEN 3 WHEN cs < 80 THEN 2 ELSE 1 END
                            ELSE CASE WHEN cs < 55 THEN 1 ELSE 2 END END AS INTEGER) AS CSATScore
    FROM (SELECT CustomerKey, tid, trigger, SurveyDate, cs,
            CAST(CASE WHEN adj >= 0.80 THEN 8 + CASE WHEN ns < 55 THEN 2 WHEN ns < 85 THEN 1 ELSE 0 END
                      WHEN adj >= 0.60 THEN 6 + CASE WHEN ns < 50 THEN 2 WHEN ns < 85 THEN 1 ELSE 0 END
                      WHEN adj >= 0.40 THEN 5 + {sdraw('sv_nps_lo', 3, *_SK)}
                      WHEN adj >= 0.25 THEN 3 + {sdraw('sv_nps_lo', 4, *_SK)}
                      ELSE {sdraw('sv_nps_lo', 5, *_SK)} END AS INTEGER) AS NPSScore
          FROM (SELECT CustomerKey, tid, trigger,
                  least(CAST(FirstPurchaseDate + CAST(base + {snoise('sv_day', *_SK)} % md AS INTEGER) AS DATE), max_date) AS SurveyDate,
                  CASE WHEN tid = 1 THEN score * {SV_POST_FACTOR} WHEN tid = 2 THEN score * 1.00
                       ELSE score * (CAST({SV_ANNUAL_FACTOR[0]} AS DOUBLE) + {sdraw('sv_annual', SV_ANNUAL_FACTOR[1], *_SK)} / CAST(1000.0 AS DOUBLE)) END AS adj,
                  {sdraw('sv_nps', 100, *_SK)} AS ns, {sdraw('sv_csat', 100, *_SK)} AS cs
                FROM (SELECT s.*, t.* FROM (
                        SELECT b.CustomerKey, b.TotalOrders, b.FirstPurchaseDate, sc.max_date,
                          datediff('day', b.FirstPurchaseDate, sc.max_date) AS tenure,
                          CAST({_sql_dec_bands('b.TotalOrders', SV_FREQ, SV_FREQ_ELSE, '>=')}
                             + {_sql_dec_bands("datediff('day', b.LastPurchaseDate, sc.max_date)", SV_RECENCY, SV_RECENCY_ELSE, '<')}
                             + CASE WHEN b.ReturnRate = 0 THEN {SV_RETURN_ZERO} ELSE {_sql_dec_bands('b.ReturnRate', SV_RETURN, SV_RETURN_ELSE, '<')} END
                             + {_sql_dec_bands('b.TotalSpend', SV_SPEND, SV_SPEND_ELSE, '>')} AS DOUBLE) AS score
                        FROM customer_behaviour b JOIN dim_customer c ON b.CustomerKey = c.CustomerKey
                        CROSS JOIN scalars sc
                        WHERE c.CustomerType = 'Person'
                          AND {sdraw('sv_sample', 100, 'b.CustomerKey')} <
                              CASE {' '.join(f'WHEN b.TotalOrders >= {n} THEN {p}' for n, p in SV_SAMPLE)} ELSE {SV_SAMPLE_ELSE} END) s
                      CROSS JOIN (VALUES {', '.join(f"('{nm}', {tid}, {base}, {md})" for nm, tid, base, md, _, _ in SV_TRIGGERS)})
                        t(trigger, tid, base, md)
                      WHERE t.tid = 1 OR (t.tid = 2 AND s.tenure > 200 AND s.TotalOrders >= 2)
                         OR (t.tid = 3 AND s.tenure > 380 AND s.TotalOrders >= 3)) x) y) z) w""",
         ("customer_behaviour", "dim_customer", "scalars"))


# =============================================================================
# P4  FactMarketingSpend - monthly spend back-calibrated from acquisitions
# =============================================================================
# --- fixed values ------------------------------------------------------------
MS_SPEND_NOISE = (800, 400)     # spend factor = (800 + 0..399) / 1000
# impressions: ("per_customer", base, modulus) or ("per_spend", cost per mille divisor)
MS_IMPRESSIONS = {1: ("n", 80, 40), 2: ("spend", 40), 3: ("spend", 12), 4: ("n", 35, 25),
                  5: ("n", 3, 5), 6: ("n", 12, 13), 7: ("spend", 15)}
MS_IMPR_SPEND_NOISE = (850, 300)    # (850 + 0..299) / 1000
MS_CTR = {1: 35, 2: 35, 3: 9, 4: 35, 5: None, 6: 50, 7: 15}  # thousandths; None: clicks = customers
MS_CLICK_NOISE = (800, 400)         # (800 + 0..399) / 1000
# -----------------------------------------------------------------------------


def monthly_seasonality(m) -> DataFrame:
    """Month revenue and its index against the average month (tens of rows)."""
    g = order_totals(m).groupBy((F.year("OrderDate") * 100 + F.month("OrderDate")).alias("YearMonth")).agg(
        F.sum("amt").cast("decimal(19,4)").alias("MonthRevenue"))
    tot = g.agg(F.sum("MonthRevenue").alias("tot"), F.count(F.lit(1)).alias("n"))
    g = g.crossJoin(F.broadcast(tot))
    # revenue / avg(revenue) = revenue * n / total, as one exact division
    si = ratio(F.col("MonthRevenue") * F.col("n").cast("decimal(6,0)"), "tot", 4, scale=4, den_scale=4)
    return g.select("YearMonth", "MonthRevenue", si.alias("SeasonIndex"))


@gen_table("marketing_spend")
def gen_marketing_spend(m) -> DataFrame:
    """Spend, impressions and clicks per (month, channel) with acquisitions."""
    ca = m.get(gen_customer_acquisition)
    ma = ca.groupBy((F.year("AcquisitionDate") * 100 + F.month("AcquisitionDate")).alias("YearMonth"),
                    "AcquisitionChannelKey").agg(F.count(F.lit(1)).alias("n"))
    ch = m.ref_acquisition_channel.select(
        "AcquisitionChannelKey",
        ratio(F.col("EstimatedCACLow") + F.col("EstimatedCACHigh"), F.lit(2), 2, 8, scale=4).alias("mid"))
    si = monthly_seasonality(m).select("YearMonth", "SeasonIndex")
    x = ma.join(ch, "AcquisitionChannelKey").join(F.broadcast(si), "YearMonth", "left")  # months: bounded by calendar
    keys = ("YearMonth", "AcquisitionChannelKey")
    lo, span = MS_SPEND_NOISE
    factor = ((F.lit(lo) + draw("ms_spend", span, *keys)) * F.lit(Decimal("0.001"))).cast("decimal(6,3)")
    # 12 + 8 + 8 + 6 digits: the product stays exact within 38
    spend = (F.col("n").cast("decimal(12,0)") * F.col("mid")
             * F.coalesce(F.col("SeasonIndex"), F.lit(Decimal("1.0"))).cast("decimal(8,4)") * factor) \
        .cast("decimal(19,4)")
    # each draw is a column of its own, made once
    x = x.select("YearMonth", "AcquisitionChannelKey", "n", F.greatest(spend, F.lit(Decimal("0")).cast("decimal(19,4)")).alias("spend"),
                 noise("ms_imp", *keys).alias("r_imp"), noise("ms_clk", *keys).alias("r_clk"))
    k = F.col("AcquisitionChannelKey")
    ilo, ispan = MS_IMPR_SPEND_NOISE
    imp = F.lit(0).cast("long")
    for key in sorted(MS_IMPRESSIONS, reverse=True):
        spec = MS_IMPRESSIONS[key]
        if spec[0] == "n":
            e = F.col("n").cast("long") * (spec[1] + F.pmod(F.col("r_imp"), F.lit(spec[2])))
        else:
            # floor(spend / cost per mille * 1000 * (850 + draw) / 1000), in integers
            units = (F.col("spend") * F.lit(Decimal(10000))).cast("decimal(24,0)") * (F.lit(ilo) + F.pmod(F.col("r_imp"), F.lit(ispan))).cast("decimal(5,0)")
            e = F.call_function("div", units, F.lit(Decimal(spec[1] * 10000)))
        imp = F.when(k == key, e.cast("long")).otherwise(imp)
    x = x.withColumn("imp", imp)
    clo, cspan = MS_CLICK_NOISE
    clk = F.col("n").cast("long")
    for key in sorted(MS_CTR, reverse=True):
        ctr = MS_CTR[key]
        if ctr is not None:
            e = F.call_function("div", F.col("imp") * ctr * (F.lit(clo) + F.pmod(F.col("r_clk"), F.lit(cspan))), F.lit(1000000).cast("long"))
            clk = F.when(k == key, e).otherwise(clk)
    x = x.withColumn("clk", F.greatest(F.col("n").cast("long"), clk))
    n = F.col("n").cast("long")
    return x.select(
        (F.col("YearMonth").cast("long") * 10 + k).alias("MarketingSpendID"),
        "YearMonth", (F.col("YearMonth") * 100 + 1).alias("MonthStartDateKey"), "AcquisitionChannelKey",
        F.col("spend").alias("MonthlySpend"), F.col("imp").alias("Impressions"), F.col("clk").alias("Clicks"),
        n.alias("NewCustomersAcquired"),
        F.when(F.col("clk") > 0, ratio("spend", "clk", 4, scale=4)).alias("CostPerClick"),
        F.when(n > 0, ratio("spend", n, 4, scale=4)).alias("CostPerAcquisition"),
        F.when(F.col("imp") > 0, ratio(F.col("clk") * 100, "imp", 2, 5)).alias("ClickThroughRate"),
    )


_MK = ("YearMonth", "AcquisitionChannelKey")


def _sql_imp_case() -> str:
    parts = []
    for key, spec in MS_IMPRESSIONS.items():
        if spec[0] == "n":
            parts.append(f"WHEN {key} THEN CAST(n AS BIGINT) * ({spec[1]} + {sdraw('ms_imp', spec[2], *_MK)})")
        else:
            parts.append(f"WHEN {key} THEN CAST((CAST(spend * 10000 AS HUGEINT) * ({MS_IMPR_SPEND_NOISE[0]} + "
                         f"{sdraw('ms_imp', MS_IMPR_SPEND_NOISE[1], *_MK)})) // {spec[1] * 10000} AS BIGINT)")
    return "CASE AcquisitionChannelKey " + " ".join(parts) + " ELSE 0 END"


def _sql_clk_case() -> str:
    parts = []
    for key, ctr in MS_CTR.items():
        if ctr is not None:
            parts.append(f"WHEN {key} THEN (CAST(imp AS BIGINT) * {ctr} * ({MS_CLICK_NOISE[0]} + {sdraw('ms_clk', MS_CLICK_NOISE[1], *_MK)})) // 1000000")
    return "CASE AcquisitionChannelKey " + " ".join(parts) + " ELSE CAST(n AS BIGINT) END"


register("monthly_seasonality", f"""
  SELECT YearMonth, MonthRevenue,
    {sratio('MonthRevenue * CAST(n AS DECIMAL(6,0))', 'tot', 4, scale=4, den_scale=4)} AS SeasonIndex
  FROM (SELECT year(DateKey) * 100 + month(DateKey) AS YearMonth, CAST(sum(SalesAmount) AS DECIMAL(19,4)) AS MonthRevenue
        FROM fact_online_sales GROUP BY 1) g
  CROSS JOIN (SELECT sum(MonthRevenue) AS tot, count(*) AS n FROM (
      SELECT CAST(sum(SalesAmount) AS DECIMAL(19,4)) AS MonthRevenue FROM fact_online_sales
      GROUP BY year(DateKey) * 100 + month(DateKey)) a) t""", ("fact_online_sales",))
register("gen_marketing_spend", f"""
  SELECT CAST(YearMonth AS BIGINT) * 10 + AcquisitionChannelKey AS MarketingSpendID, YearMonth,
    YearMonth * 100 + 1 AS MonthStartDateKey, AcquisitionChannelKey, spend AS MonthlySpend, imp AS Impressions,
    clk AS Clicks, CAST(n AS BIGINT) AS NewCustomersAcquired,
    CASE WHEN clk > 0 THEN {sratio('spend', 'clk', 4, scale=4)} END AS CostPerClick,
    CASE WHEN n > 0 THEN {sratio('spend', 'n', 4, scale=4)} END AS CostPerAcquisition,
    CASE WHEN imp > 0 THEN {sratio('clk * 100', 'imp', 2, 5)} END AS ClickThroughRate
  FROM (SELECT *, greatest(CAST(n AS BIGINT), {_sql_clk_case()}) AS clk
    FROM (SELECT *, {_sql_imp_case()} AS imp
      FROM (SELECT ma.YearMonth, ma.AcquisitionChannelKey, ma.n,
              greatest(CAST(CAST(ma.n AS DECIMAL(12,0)) * {sratio('ch.EstimatedCACLow + ch.EstimatedCACHigh', '2', 2, 8, scale=4)}
                * CAST(coalesce(si.SeasonIndex, 1.0) AS DECIMAL(8,4))
                * CAST(({MS_SPEND_NOISE[0]} + {sdraw('ms_spend', MS_SPEND_NOISE[1], 'ma.YearMonth', 'ma.AcquisitionChannelKey')}) * 0.001 AS DECIMAL(6,3))
                AS DECIMAL(19,4)), CAST(0 AS DECIMAL(19,4))) AS spend
            FROM (SELECT year(AcquisitionDate) * 100 + month(AcquisitionDate) AS YearMonth, AcquisitionChannelKey, count(*) AS n
                  FROM gen_customer_acquisition GROUP BY 1, 2) ma
            JOIN ref_acquisition_channel ch ON ma.AcquisitionChannelKey = ch.AcquisitionChannelKey
            LEFT JOIN monthly_seasonality si ON ma.YearMonth = si.YearMonth) a) b) c""",
         ("gen_customer_acquisition", "ref_acquisition_channel", "monthly_seasonality"))
