"""Source adapter: the driver's TPC-H-style parquet tables -> the retail source schema.

The retail source database (online/store sales facts, inventory, quotas,
exchange rates and their dimensions) is not shipped; this module derives an
equivalent from ``lineitem/orders/customer/part/supplier/nation/region``.
Every derived attribute is a deterministic function of the input keys, so
the DuckDB twin in ``tessera.oracle.adapter_sql`` computes identical values.

Scale notes
-----------
* Aggregating consumers read ``online_lines``/``store_lines`` (no line keys);
  order-grain pipelines aggregate ``line_measures`` by order and join the
  orders afterwards.
* Keys are 64-bit; padded text keys are never shortened.
* Line keys (``OnlineSalesKey``, ``SalesOrderLineNumber``, ``SalesKey``) are
  numbered on the lines' identity alone, in ranges of an order's lines, so one
  huge order is spread over tasks, and do not move when other orders change
  (``line_numbers``). Lines with their measures are shuffled once, by identity.
* Dimensions derived from ``customer/part/supplier`` grow with the data, so
  they are never force-broadcast; AQE converts those joins to broadcasts
  only when the runtime size is below ``autoBroadcastJoinThreshold``.
* Geography (nation x region) is fixed-size and broadcast explicitly.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import draw, noise_term, noises, pad

D = lambda s: F.lit(Decimal(s))  # noqa: E731  decimal literal (Spark's lit(0.6) is DOUBLE)

# --- fixed values of the adapter (driver data -> retail vocabulary) ---------
CONTINENTS = {"AMERICA": "North America", "ASIA": "Asia", "EUROPE": "Europe"}
PRODUCT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EDUCATION = ["Bachelors", "Graduate Degree", "High School", "Partial College", "Partial High School"]
OCCUPATION = ["Clerical", "Management", "Manual", "Professional", "Skilled Manual"]
STORE_TYPES = ["Store", "Store", "Online", "Catalog"]
CHANNELS = [(1, "Store"), (2, "Online"), (3, "Catalog"), (4, "Reseller"), (5, "Outlet")]
SCENARIOS = [(1, "Actual", Decimal("1.00")), (2, "Budget", Decimal("1.05")), (3, "Forecast", Decimal("0.98"))]
CURRENCIES = [(1, "USD", "US Dollar"), (2, "EUR", "Euro"), (3, "GBP", "British Pound"), (4, "XTS", "Test Currency")]
DEPARTMENTS = ["Sales", "Finance", "Logistics", "Marketing", "Operations"]
# -----------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Identity of a sales line: the order key plus the columns that make a line
# unique within its order ((order, line number) alone is not unique in the data).
LINE_ORDER = ["OrderKey", "_ln", "_pk", "_sk", "_sd", "_ep"]
# Lines of an order are numbered in groups of line number and this many parts.
PARTS_IN_GROUP = 1024
LINES_PER_ORDER = 10**12  # room for the line number in a line key


def line_measures(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Lines of one status with their measures, from lineitem alone.

    Order-grain pipelines aggregate these by order before they join the
    orders, so a hot order is combined map-side."""
    li = read(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    )
    ext = F.col("l_extendedprice").cast("decimal(15,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    sales_amount = (ext * (F.lit(1) - disc) * D("0.004")).cast("decimal(19,4)")
    qty = F.col("l_quantity").cast("int")
    return li.select(
        F.col("l_orderkey").cast("long").alias("OrderKey"),
        F.col("l_suppkey").cast("long").alias("StoreKey"),
        F.col("l_partkey").cast("long").alias("ProductKey"),
        (F.round(F.col("l_discount") * 100).cast("int") + 1).alias("PromotionKey"),
        (draw("currency", 3, "l_orderkey") + 1).cast("int").alias("CurrencyKey"),  # one currency per order
        F.concat(F.lit("SO"), pad("l_orderkey", 10)).alias("SalesOrderNumber"),
        qty.alias("SalesQuantity"),
        sales_amount.alias("SalesAmount"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(0).alias("ReturnQuantity"),
        F.when(F.col("l_returnflag") == "R", sales_amount)
        .otherwise(D("0").cast("decimal(19,4)")).alias("ReturnAmount"),
        F.when(F.col("l_discount") > 0, qty).otherwise(0).alias("DiscountQuantity"),
        (ext * disc * D("0.004")).cast("decimal(19,4)").alias("DiscountAmount"),
        (sales_amount * D("0.6")).cast("decimal(19,4)").alias("TotalCost"),
        (F.col("l_extendedprice") / F.col("l_quantity") / 250 * 0.6).alias("UnitCost"),
        (F.col("l_extendedprice") / F.col("l_quantity") / 250).alias("UnitPrice"),
        F.col("l_linenumber").alias("_ln"), F.col("l_partkey").alias("_pk"), F.col("l_suppkey").alias("_sk"),
        F.col("l_shipdate").alias("_sd"), F.col("l_extendedprice").alias("_ep"),
    )


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``OrderKey, OrderDate, CustomerKey`` of every order."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("OrderKey"), F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_custkey").cast("long").alias("CustomerKey"))


def orders_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a line takes from its order: date, customer and channel."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("OrderKey"), F.col("o_orderdate").alias("DateKey"),
        F.col("o_custkey").cast("long").alias("CustomerKey"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ChannelKey"))


def sales_lines(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Lines of one status joined to their order, with measures; no line keys."""
    return line_measures(spark, sf_dir, status).join(orders_of_lines(spark, sf_dir), "OrderKey")


def line_identities(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """The identity columns of the lines of one status."""
    return read(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status).select(
        F.col("l_orderkey").cast("long").alias("OrderKey"), F.col("l_linenumber").alias("_ln"), F.col("l_partkey").alias("_pk"),
        F.col("l_suppkey").alias("_sk"), F.col("l_shipdate").alias("_sd"), F.col("l_extendedprice").alias("_ep"))


def line_numbers(identities: DataFrame, orders: DataFrame) -> DataFrame:
    """Each identity once, with ``LineNumber``, its place among its order's
    identities, and the columns of ``orders(OrderKey, ..)``.

    Identities are numbered inside groups of (order, line number, range of
    parts), so the lines of one huge order are sorted in many tasks; a group's
    start is the number of identities in the order's groups before it. The
    starts, one row for each group, carry the order's columns, so the
    identities are shuffled by group only. A new line moves only later lines
    of its own order; lines that repeat a whole identity share its number."""
    from pyspark.sql import Window

    group = ["OrderKey", "_ln", "_range"]
    k = identities.withColumn("_range", F.floor(F.col("_pk") / PARTS_IN_GROUP))
    known = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in group))
    # Only these get a number. Asked for here, so that both readers of the
    # identities below share one shuffle (the join would ask on its side alone).
    numbered, rest = k.where(known), k.where(~known)
    inside = Window.partitionBy(*group).orderBy(*LINE_ORDER[2:])
    placed = numbered.withColumn("_place", F.dense_rank().over(inside)).groupBy(*group, *LINE_ORDER[2:]).agg(F.first("_place").alias("_place"))
    sizes = placed.groupBy(*group).agg(F.max("_place").alias("_n"))
    # lines without a number or part still take a place in their order, before the others
    rest = rest.select(*group, *LINE_ORDER[2:]).distinct().groupBy(*group).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    sizes = sizes.unionByName(rest)
    before = Window.partitionBy("OrderKey").orderBy("_ln", "_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")).join(orders, "OrderKey")
    return placed.join(starts, group).withColumn("LineNumber", (F.col("_start") + F.col("_place")).cast("long")).drop("_start", "_place", "_range")


def line_key(name: str) -> F.Column:
    """The exact pair (order, line number) as one decimal."""
    pair = F.col("OrderKey").cast("decimal(20,0)") * F.lit(Decimal(LINES_PER_ORDER)) + F.col("LineNumber")
    return pair.cast("decimal(38,0)").alias(name)


def numbered_lines(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Lines of one status with measures, order columns and ``LineNumber``.
    The join on the whole identity has no hot key."""
    numbers = line_numbers(line_identities(spark, sf_dir, status), orders_of_lines(spark, sf_dir))
    return line_measures(spark, sf_dir, status).join(numbers, LINE_ORDER)


_MEASURES = [
    "SalesQuantity", "SalesAmount", "ReturnQuantity", "ReturnAmount", "DiscountQuantity",
    "DiscountAmount", "TotalCost", "UnitCost", "UnitPrice",
]


def online_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FactOnlineSales without the line keys (for aggregating consumers)."""
    s = sales_lines(spark, sf_dir, "O")
    return s.select("DateKey", "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey", "CustomerKey",
                    "SalesOrderNumber", *_MEASURES, "OrderKey")


def store_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FactSales without the line key."""
    s = sales_lines(spark, sf_dir, "F")
    return s.select("DateKey", "ChannelKey", "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey", *_MEASURES)


def fact_online_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FactOnlineSales: open lines ('O') with OnlineSalesKey and SalesOrderLineNumber."""
    s = numbered_lines(spark, sf_dir, "O")
    return s.select(
        line_key("OnlineSalesKey"), "DateKey", "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey", "CustomerKey",
        "SalesOrderNumber", F.col("LineNumber").alias("SalesOrderLineNumber"), *_MEASURES, "OrderKey",
    )


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FactSales (store channel): fulfilled lines ('F') with SalesKey; no customer."""
    s = numbered_lines(spark, sf_dir, "F")
    return s.select(line_key("SalesKey"), "DateKey", "ChannelKey", "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey",
                    *_MEASURES, "OrderKey", "LineNumber")


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    cont = F.col("r_name")
    for k, v in reversed(list(CONTINENTS.items())):
        cont = F.when(F.col("r_name") == k, F.lit(v)).otherwise(cont)
    g = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("int").alias("GeographyKey"),
        cont.alias("ContinentName"),
        F.col("n_name").alias("RegionCountryName"),
        F.concat(F.col("n_name"), F.lit(" State")).alias("StateProvinceName"),
        F.concat(F.col("n_name"), F.lit(" City")).alias("CityName"),
    )
    return F.broadcast(g)  # nation x region: 25 rows, fixed by the schema


def _pick(values: list[str], idx) -> F.Column:
    e = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        e = F.when(idx == i, F.lit(v)).otherwise(e)
    return e


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    first = (
        read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey"))
        .agg(F.min("o_orderdate").cast("date").alias("DateFirstPurchase"))
    )
    k = F.col("c_custkey")
    company = F.col("c_mktsegment") == "MACHINERY"
    suffix = F.regexp_extract("c_name", "#(.*)$", 1)
    df = c.join(first, c.c_custkey == first.o_custkey, "left")
    return df.select(
        k.cast("long").alias("CustomerKey"),
        F.col("c_nationkey").cast("int").alias("GeographyKey"),
        F.lit("Customer").alias("FirstName"),
        F.when(draw("mid", 4, k) == 0, F.lit(" ")).when(draw("mid", 4, k) == 1, F.lit("J"))
        .alias("MiddleName"),
        suffix.alias("LastName"),
        F.when(draw("gender", 2, k) == 0, "M").otherwise("F").alias("Gender"),
        F.when(draw("marital", 2, k) == 0, "M").otherwise("S").alias("MaritalStatus"),
        F.when(~company, F.date_add(F.lit("1940-01-01").cast("date"), draw("birth", 18250, k).cast("int")))
        .alias("BirthDate"),
        ((F.col("c_acctbal").cast("decimal(15,2)") + 1000) * 15).cast("decimal(19,4)").alias("YearlyIncome"),
        draw("children", 5, k).cast("int").alias("TotalChildren"),
        draw("home", 3, k).cast("int").alias("NumberChildrenAtHome"),
        _pick(EDUCATION, draw("edu", 5, k)).alias("Education"),
        _pick(OCCUPATION, draw("occ", 5, k)).alias("Occupation"),
        draw("house", 2, k).cast("string").alias("HouseOwnerFlag"),
        draw("cars", 5, k).cast("int").alias("NumberCarsOwned"),
        F.concat(draw("addr", 9000, k).cast("string"), F.lit(" Main St")).alias("AddressLine1"),
        F.lit(None).cast("string").alias("AddressLine2"),
        F.concat(F.lit("555-"), pad(draw("phone", 10000, k), 4)).alias("Phone"),
        F.concat(F.lit("customer"), suffix, F.lit("@example.com")).alias("EmailAddress"),
        F.when(company, "Company").otherwise("Person").alias("CustomerType"),
        F.when(company, F.col("c_name")).alias("CompanyName"),
        F.col("DateFirstPurchase"),
    )


def _category_key() -> F.Column:
    e = F.lit(99)
    for i, t in reversed(list(enumerate(PRODUCT_TYPES))):
        e = F.when(F.col("p_type") == t, F.lit(i + 1)).otherwise(e)
    return e


def _brand_no() -> F.Column:
    return F.regexp_extract("p_brand", "#(\\d+)", 1).cast("int")


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = (F.col("p_retailprice").cast("decimal(15,2)") * D("0.004")).cast("decimal(19,4)")
    avail = F.date_add(F.lit("1994-01-01").cast("date"), draw("avail", 730, k).cast("int"))
    return p.select(
        k.cast("long").alias("ProductKey"),
        (_category_key() * 100 + _brand_no()).alias("ProductSubcategoryKey"),
        pad(k, 7).alias("ProductLabel"),
        F.col("p_name").alias("ProductName"),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")")).alias("ProductDescription"),
        F.concat(F.lit("Manufacturer "), F.pmod(_brand_no(), F.lit(5)).cast("string")).alias("Manufacturer"),
        F.col("p_brand").alias("BrandName"),
        F.when(F.col("p_size") < 15, "Economy").when(F.col("p_size") < 35, "Regular")
        .otherwise("Deluxe").alias("ClassName"),
        F.concat(F.lit("Style "), draw("style", 4, k).cast("string")).alias("StyleName"),
        F.split("p_name", " ").getItem(0).alias("ColorName"),
        F.col("p_size").cast("string").alias("Size"),
        F.when(F.col("p_size") < 25, "0-24").otherwise("25+").alias("SizeRange"),
        (F.col("p_size") * 0.5).alias("Weight"),
        F.lit("each").alias("UnitOfMeasureName"),
        F.when(draw("stock", 3, k) == 0, "High").when(draw("stock", 3, k) == 1, "Mid")
        .otherwise("Low").alias("StockTypeName"),
        (price * D("0.6")).cast("decimal(19,4)").alias("UnitCost"),
        price.alias("UnitPrice"),
        avail.alias("AvailableForSaleDate"),
        F.when(draw("stop", 10, k) == 0,
               F.date_add(F.lit("1999-01-01").cast("date"), draw("stopday", 1500, k).cast("int")))
        .alias("StopSaleDate"),
    )


def dim_product_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    return p.select(
        (_category_key() * 100 + _brand_no()).alias("ProductSubcategoryKey"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("ProductSubcategoryName"),
        _category_key().alias("ProductCategoryKey"),
    )


def dim_product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_type").distinct()
    return p.select(_category_key().alias("ProductCategoryKey"), F.col("p_type").alias("ProductCategoryName"))


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    open_d = F.date_add(F.lit("1985-01-01").cast("date"), draw("open", 3650, k).cast("int"))
    close_d = F.when(draw("close", 8, k) == 0, F.date_add(open_d, (3650 + draw("closeday", 3000, k)).cast("int")))
    return s.select(
        k.cast("long").alias("StoreKey"),
        F.col("s_nationkey").cast("int").alias("GeographyKey"),
        F.col("s_name").alias("StoreName"),
        _pick(STORE_TYPES, draw("stype", 4, k)).alias("StoreType"),
        F.concat(F.col("s_name"), F.lit(" store")).alias("StoreDescription"),
        (draw("manager", 100, k) + 1).cast("int").alias("StoreManager"),
        (draw("staff", 60, k) + 5).cast("int").alias("EmployeeCount"),
        F.when(draw("area0", 20, k) != 0, (draw("area", 60000, k) + 500).cast("double")).alias("SellingAreaSize"),
        open_d.alias("OpenDate"),
        close_d.alias("CloseDate"),
        F.date_add(open_d, draw("remodel", 2000, k).cast("int")).alias("LastRemodelDate"),
        F.when(close_d.isNotNull(), F.lit("Lease expired")).alias("CloseReason"),
        F.concat(F.lit("555-1"), pad(k, 3)).alias("StorePhone"),
        F.concat(F.lit("555-2"), pad(k, 3)).alias("StoreFax"),
        F.concat(draw("saddr", 900, k).cast("string"), F.lit(" Market St")).alias("AddressLine1"),
        F.lit(None).cast("string").alias("AddressLine2"),
        pad(draw("zip", 100000, k), 5).alias("ZipCode"),
    )


def dim_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "lineitem").select("l_discount").distinct()
    k = (F.round(F.col("l_discount") * 100).cast("int") + 1)
    return d.select(
        k.alias("PromotionKey"),
        pad(k, 3).alias("PromotionLabel"),
        F.when(k == 1, F.lit("No Discount"))
        .otherwise(F.concat(F.lit("Discount "), (k - 1).cast("string"), F.lit("%"))).alias("PromotionName"),
        F.when(k == 1, F.lit("No Discount")).otherwise(F.lit("Volume Discount")).alias("PromotionDescription"),
        F.when(k == 1, F.lit("No Discount")).otherwise(F.lit("Seasonal Discount")).alias("PromotionType"),
        F.when(k == 1, F.lit("No Discount")).otherwise(F.lit("Customer")).alias("PromotionCategory"),
        F.col("l_discount").alias("DiscountPercent"),
        F.lit(1).alias("MinQuantity"),
        F.lit(None).cast("int").alias("MaxQuantity"),
        F.date_add(F.lit("1995-01-01").cast("date"), draw("pstart", 365, k).cast("int")).alias("StartDate"),
        F.when(draw("pend", 3, k) != 0,
               F.date_add(F.lit("1997-01-01").cast("date"), draw("pendday", 2000, k).cast("int"))).alias("EndDate"),
    )


def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey").cast("long") + 1
    boss = F.expr("(cast(s_suppkey as bigint) + 1) div 10")
    hire = F.date_add(F.lit("1996-01-01").cast("date"), draw("hire", 4000, k).cast("int"))
    return s.select(
        k.alias("EmployeeKey"),
        F.when(boss > 0, boss).alias("ParentEmployeeKey"),
        F.lit("Employee").alias("FirstName"),
        F.when(draw("emid", 3, k) == 0, F.lit("")).alias("MiddleName"),
        pad(k, 5).alias("LastName"),
        F.when(boss == 0, "Director").otherwise("Associate").alias("Title"),
        F.concat(F.lit("employee"), k.cast("string"), F.lit("@example.com")).alias("EmailAddress"),
        F.concat(F.lit("555-3"), pad(k, 4)).alias("Phone"),
        F.when(draw("egender", 2, k) == 0, "M").otherwise("F").alias("Gender"),
        F.when(draw("emarital", 2, k) == 0, "M").otherwise("S").alias("MaritalStatus"),
        _pick(DEPARTMENTS, draw("dept", 5, k)).alias("DepartmentName"),
        (draw("dept", 5, k) == 0).alias("SalesPersonFlag"),
        (draw("salaried", 2, k) == 0).alias("SalariedFlag"),
        (draw("status", 10, k) != 0).alias("CurrentFlag"),
        (F.lit(10) + draw("rate", 40, k)).cast("decimal(19,4)").alias("BaseRate"),
        draw("vacation", 100, k).cast("int").alias("VacationHours"),
        F.lit(2).alias("PayFrequency"),
        hire.alias("HireDate"),
        hire.alias("StartDate"),
        F.lit(None).cast("date").alias("EndDate"),
        F.date_add(F.lit("1950-01-01").cast("date"), draw("ebirth", 15000, k).cast("int")).alias("BirthDate"),
        F.when(draw("status", 10, k) != 0, F.lit("Current")).alias("Status"),
    )


def _order_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per calendar day of the order-date span (a few thousand rows)."""
    b = _order_date_bounds(spark, sf_dir)
    d = b.select(F.explode(F.sequence("lo", "hi")).alias("Datekey"))
    m, dd, dow = F.month("Datekey"), F.dayofmonth("Datekey"), F.dayofweek("Datekey")
    holiday = (
        F.when((m == 1) & (dd == 1), "New Year's Day")
        .when((m == 7) & (dd == 4), "Independence Day")
        .when((m == 12) & (dd == 25), "Christmas Day")
    )
    return d.select(
        "Datekey",
        F.when(dow.isin(1, 7), "WeekEnd").otherwise("WorkDay").alias("IsWorkDay"),
        F.when(holiday.isNotNull(), 1).otherwise(0).alias("IsHoliday"),
        holiday.alias("HolidayName"),
        F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer").otherwise("Autumn").alias("EuropeSeason"),
        F.when(m.isin(11, 12), "Holiday Season").when(m.isin(8, 9), "Back to School")
        .otherwise("None").alias("NorthAmericaSeason"),
        F.when(m.isin(1, 2), "Spring Festival").when(m.isin(10, 11), "Golden Week")
        .otherwise("None").alias("AsiaSeason"),
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    rows = [(k, f"{k:02d}", n, f"{n} channel") for k, n in CHANNELS]
    return F.broadcast(spark.createDataFrame(rows, "ChannelKey int, ChannelLabel string, ChannelName string, ChannelDescription string"))


def dim_scenario(spark: SparkSession) -> DataFrame:
    rows = [(k, f"{k:02d}", n, f"{n} scenario") for k, n, _ in SCENARIOS]
    return F.broadcast(spark.createDataFrame(rows, "ScenarioKey int, ScenarioLabel string, ScenarioName string, ScenarioDescription string"))


def dim_currency(spark: SparkSession) -> DataFrame:
    rows = [(k, f"{k:03d}", code, desc) for k, code, desc in CURRENCIES]
    return F.broadcast(spark.createDataFrame(rows, "CurrencyKey int, CurrencyLabel string, CurrencyName string, CurrencyDescription string"))


def fact_exchange_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-start rate per currency over the order-date span (currency 1 = USD base)."""
    b = _order_date_bounds(spark, sf_dir)
    months = b.select(
        F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month"))).alias("d")
    )
    cur = spark.createDataFrame([(k,) for k, _, _ in CURRENCIES], "CurrencyKey int")
    x = months.crossJoin(F.broadcast(cur))  # months x 4 currencies, both bounded and tiny
    base = (
        F.when(F.col("CurrencyKey") == 1, F.lit(1.0))
        .when(F.col("CurrencyKey") == 2, F.lit(0.85))
        .when(F.col("CurrencyKey") == 3, F.lit(0.65))
        .otherwise(F.lit(0.0))
    )
    dk = F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")  # integer noise key
    wiggle = F.when(F.col("CurrencyKey").isin(2, 3), (draw("fx", 100, "CurrencyKey", dk) - 50) / 1000.0).otherwise(0.0)
    avg = base + wiggle
    eod = avg * F.when(F.col("CurrencyKey").isin(2, 3), 1 + (draw("fxe", 21, "CurrencyKey", dk) - 10) / 1000.0).otherwise(1.0)
    return x.select(
        "CurrencyKey",
        F.col("d").cast("timestamp").alias("DateKey"),
        avg.alias("AverageRate"),
        eod.alias("EndOfDayRate"),
    )


def fact_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly store x product stock snapshot, aggregated from sold lines."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    g = j.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("m"),
        F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"),
    ).agg(F.sum("l_quantity").alias("q"))
    keys = (F.year("m") * 100 + F.month("m"), "s", "p")  # integer noise keys
    draws = {"ss": ("inv_ss", 40), "mult": ("inv_mult", 100), "lo": ("inv_lo", 100), "mid": ("inv_mid", 3), "hi": ("inv_hi", 50), "cost": ("inv_cost", 2000),
             "days": ("inv_days", 365), "mn": ("inv_min", 30), "mx": ("inv_max", 300), "age0": ("inv_age0", 10), "age": ("inv_age", 365)}
    terms = [noise_term(k).alias(f"k{i}") for i, k in enumerate(keys)]
    d = g.select("m", "s", "p", "q", *terms)
    drawn = noises([salt for salt, _ in draws.values()], *[f"k{i}" for i in range(len(keys))])
    d = d.select("m", "s", "p", "q", *[(x % F.lit(n)).alias(name) for x, (name, (_, n)) in zip(drawn, draws.items())])
    d = d.withColumn("ss", (F.col("ss") + 5).cast("int"))
    ss, mult = F.col("ss"), F.col("mult")
    on_hand = (
        F.when(mult < 2, F.lit(0))
        .when(mult < 17, F.floor(ss * (F.col("lo") / 100.0)))
        .when(mult < 86, ss + 1 + F.col("mid") * ss)
        .when(mult < 99, 4 * ss + 1 + F.col("hi"))
        .otherwise(9 * ss)
        .cast("int")
    )
    return d.select(
        # the exact key: month, store and product
        F.concat_ws("-", F.date_format("m", "yyyyMM"), F.col("s").cast("string"), F.col("p").cast("string")).alias("InventoryKey"),
        F.col("m").cast("timestamp").alias("DateKey"),
        F.col("s").cast("long").alias("StoreKey"),
        F.col("p").cast("long").alias("ProductKey"),
        F.lit(1).alias("CurrencyKey"),
        on_hand.alias("OnHandQuantity"),
        F.col("q").cast("long").alias("OnOrderQuantity"),
        ss.alias("SafetyStockQuantity"),
        (F.lit(Decimal("1.5")) + F.col("cost") / 100).cast("decimal(19,4)").alias("UnitCost"),
        F.col("days").cast("int").alias("DaysInStock"),
        F.col("mn").cast("int").alias("MinDayInStock"),
        (F.col("mn") + F.col("mx")).cast("int").alias("MaxDayInStock"),
        F.when(F.col("age0") != 0, F.col("age").cast("int")).alias("Aging"),
    )


def fact_sales_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quota per store x product x channel for three scenarios."""
    fs = store_lines(spark, sf_dir)
    g = fs.groupBy(
        F.trunc(F.col("DateKey").cast("date"), "month").alias("m"), "StoreKey", "ProductKey", "ChannelKey"
    ).agg(
        F.sum("SalesQuantity").alias("q"),
        F.sum("SalesAmount").alias("a"),
        F.sum(F.col("SalesAmount") - F.col("TotalCost")).alias("gm"),
    )
    sc = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f).alias("f")) for k, _, f in SCENARIOS]))
    x = g.select("*", sc.alias("sc"))
    f = F.col("sc.f")
    return x.select(
        F.col("m").cast("timestamp").alias("DateKey"),
        "StoreKey", "ProductKey",
        F.lit(1).alias("CurrencyKey"),
        "ChannelKey",
        F.col("sc.k").alias("ScenarioKey"),
        (F.col("q") * f).cast("decimal(19,4)").alias("SalesQuantityQuota"),
        (F.col("a") * f).cast("decimal(19,4)").alias("SalesAmountQuota"),
        (F.col("gm") * f).cast("decimal(19,4)").alias("GrossMarginQuota"),
    )
