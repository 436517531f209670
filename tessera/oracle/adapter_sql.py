"""DuckDB twin of ``tessera.sources.adapter`` (used only by the oracle SQL).

Each entry is a CTE body over the driver's pre-registered views. DuckDB
notes: double->int casts round there (Spark truncates), so ``trunc`` first;
integer ``/`` is ``//``; ``dayofweek`` is Sunday=0.
"""

from __future__ import annotations

from decimal import Decimal

from tessera.functions import HASH_ADD, HASH_P, salt_mul, salt_seed
from tessera.sources.adapter import (
    CHANNELS, CONTINENTS, CURRENCIES, DEPARTMENTS, EDUCATION, OCCUPATION, PRODUCT_TYPES,
    SCENARIOS, STORE_TYPES,
)
from tessera.sources.reference import (
    ACQUISITION_CHANNELS, PAYMENT_METHODS, RETURN_REASONS, values_sql,
)


def noise(salt: str, *keys: str) -> str:
    """Same integer hash as ``tessera.functions.noise``."""
    p, a = HASH_P, salt_mul(salt)
    h = f"CAST({salt_seed(salt)} AS BIGINT)"
    for k in keys:
        kk = f"((CAST({k} AS BIGINT) % {p} + {p}) % {p})"
        h = f"(({h}) * {a} + {kk} * {kk} + {kk} + {HASH_ADD}) % {p}"
    h = f"(({h}) * {a} + {HASH_ADD}) % {p}"
    return f"((({h}) * ({h}) + {a}) % {p})"


def draw(salt: str, n: int, *keys: str) -> str:
    return f"({noise(salt, *keys)} % {n})"


def ratio(num: str, den: str, digits: int, precision: int = 19, scale: int = 0, den_scale: int = 0) -> str:
    """Same exact rounded quotient as ``tessera.functions.ratio``."""
    more = max(scale - digits, den_scale, 0)

    def whole(x: str, has: int, up: int) -> str:
        if not has:
            return f"(CAST({x} AS HUGEINT) * {10 ** up})"
        return f"CAST(CAST({x} AS DECIMAL({22 + has},{has})) * CAST({10 ** up} AS DECIMAL({up + 1},0)) AS HUGEINT)"

    a, b = whole(num, scale, digits + more), whole(den, den_scale, more)
    q = f"(sign({a}) * sign({b}) * ((abs({a}) * 2 + abs({b})) // nullif(abs({b}) * 2, 0)))"
    return f"CAST(CAST({q} AS DECIMAL(20,0)) * CAST({Decimal(1).scaleb(-digits)} AS DECIMAL({digits + 1},{digits})) AS DECIMAL({precision},{digits}))"


def pad(x: str, n: int) -> str:
    """Same as ``tessera.functions.pad``: never shortens."""
    s = f"CAST({x} AS VARCHAR)"
    return f"lpad({s}, CAST(greatest(length({s}), {n}) AS INTEGER), '0')"


def pick(values, idx: str) -> str:
    whens = " ".join(f"WHEN {idx} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {whens} END)"


def _case_map(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


_CAT_KEY = "(CASE " + " ".join(f"WHEN p_type = '{t}' THEN {i + 1}" for i, t in enumerate(PRODUCT_TYPES)) + " ELSE 99 END)"
_BRAND_NO = "CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER)"


_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


def _sales_lines(status: str) -> str:
    return f"""
    SELECT CAST(CAST(l.l_orderkey AS HUGEINT) * 1000000000000 + l.place AS DECIMAL(38,0)) AS LineId, l.l_orderkey AS OrderKey,
      l.place AS LineNumber,
      o.o_orderdate AS DateKey, CAST(l.l_suppkey AS BIGINT) AS StoreKey, CAST(l.l_partkey AS BIGINT) AS ProductKey,
      CAST(round(l.l_discount * 100) AS INTEGER) + 1 AS PromotionKey,
      CAST({draw('currency', 3, 'l.l_orderkey')} + 1 AS INTEGER) AS CurrencyKey,
      CAST(o.o_custkey AS BIGINT) AS CustomerKey,
      CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS ChannelKey,
      CAST(trunc(l.l_quantity) AS INTEGER) AS SalesQuantity,
      CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) * 0.004 AS DECIMAL(19,4)) AS SalesAmount,
      CASE WHEN l.l_returnflag = 'R' THEN CAST(trunc(l.l_quantity) AS INTEGER) ELSE 0 END AS ReturnQuantity,
      CASE WHEN l.l_returnflag = 'R' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) * 0.004 AS DECIMAL(19,4))
           ELSE CAST(0 AS DECIMAL(19,4)) END AS ReturnAmount,
      CASE WHEN l.l_discount > 0 THEN CAST(trunc(l.l_quantity) AS INTEGER) ELSE 0 END AS DiscountQuantity,
      CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(l.l_discount AS DECIMAL(4,2)) * 0.004 AS DECIMAL(19,4)) AS DiscountAmount,
      CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) * 0.004 AS DECIMAL(19,4)) * 0.6 AS DECIMAL(19,4)) AS TotalCost,
      l.l_extendedprice / l.l_quantity / 250 * 0.6 AS UnitCost,
      l.l_extendedprice / l.l_quantity / 250 AS UnitPrice
    FROM (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS place
          FROM lineitem WHERE l_linestatus = '{status}') l
    JOIN orders o ON l.l_orderkey = o.o_orderkey"""


_MEASURES = ("SalesQuantity, SalesAmount, ReturnQuantity, ReturnAmount, DiscountQuantity, "
             "DiscountAmount, TotalCost, UnitCost, UnitPrice")

_DK = "(year(d) * 10000 + month(d) * 100 + day(d))"
_INV_KEYS = ("(year(m) * 100 + month(m))", "s", "p")

# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "src_online_lines": (_sales_lines("O"), ()),
    "src_store_lines": (_sales_lines("F"), ()),
    "fact_online_sales": (f"""
    SELECT LineId AS OnlineSalesKey, DateKey, StoreKey, ProductKey, PromotionKey,
      CurrencyKey, CustomerKey,
      'SO' || {pad('OrderKey', 10)} AS SalesOrderNumber, LineNumber AS SalesOrderLineNumber,
      {_MEASURES}, OrderKey
    FROM src_online_lines""", ("src_online_lines",)),
    "fact_sales": (f"""
    SELECT LineId AS SalesKey, DateKey, ChannelKey, StoreKey, ProductKey, PromotionKey,
      CurrencyKey, {_MEASURES}, OrderKey, LineNumber
    FROM src_store_lines""", ("src_store_lines",)),
    "dim_geography": (f"""
    SELECT CAST(n_nationkey AS INTEGER) AS GeographyKey,
      {_case_map('r_name', CONTINENTS, 'r_name')} AS ContinentName,
      n_name AS RegionCountryName, n_name || ' State' AS StateProvinceName, n_name || ' City' AS CityName
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""", ()),
    "dim_customer": (f"""
    SELECT CAST(c_custkey AS BIGINT) AS CustomerKey, CAST(c_nationkey AS INTEGER) AS GeographyKey,
      'Customer' AS FirstName,
      CASE WHEN {draw('mid', 4, 'c_custkey')} = 0 THEN ' ' WHEN {draw('mid', 4, 'c_custkey')} = 1 THEN 'J' END AS MiddleName,
      regexp_extract(c_name, '#(.*)$', 1) AS LastName,
      CASE WHEN {draw('gender', 2, 'c_custkey')} = 0 THEN 'M' ELSE 'F' END AS Gender,
      CASE WHEN {draw('marital', 2, 'c_custkey')} = 0 THEN 'M' ELSE 'S' END AS MaritalStatus,
      CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(DATE '1940-01-01' + CAST({draw('birth', 18250, 'c_custkey')} AS INTEGER) AS DATE) END AS BirthDate,
      CAST((CAST(c_acctbal AS DECIMAL(15,2)) + 1000) * 15 AS DECIMAL(19,4)) AS YearlyIncome,
      CAST({draw('children', 5, 'c_custkey')} AS INTEGER) AS TotalChildren,
      CAST({draw('home', 3, 'c_custkey')} AS INTEGER) AS NumberChildrenAtHome,
      {pick(EDUCATION, draw('edu', 5, 'c_custkey'))} AS Education,
      {pick(OCCUPATION, draw('occ', 5, 'c_custkey'))} AS Occupation,
      CAST({draw('house', 2, 'c_custkey')} AS VARCHAR) AS HouseOwnerFlag,
      CAST({draw('cars', 5, 'c_custkey')} AS INTEGER) AS NumberCarsOwned,
      CAST({draw('addr', 9000, 'c_custkey')} AS VARCHAR) || ' Main St' AS AddressLine1,
      CAST(NULL AS VARCHAR) AS AddressLine2,
      '555-' || {pad(draw('phone', 10000, 'c_custkey'), 4)} AS Phone,
      'customer' || regexp_extract(c_name, '#(.*)$', 1) || '@example.com' AS EmailAddress,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Company' ELSE 'Person' END AS CustomerType,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name END AS CompanyName,
      f.DateFirstPurchase
    FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS DateFirstPurchase FROM orders GROUP BY o_custkey) f
      ON c_custkey = f.o_custkey""", ()),
    "dim_product": (f"""
    SELECT CAST(p_partkey AS BIGINT) AS ProductKey, {_CAT_KEY} * 100 + {_BRAND_NO} AS ProductSubcategoryKey,
      {pad('p_partkey', 7)} AS ProductLabel, p_name AS ProductName,
      p_name || ' (' || p_type || ')' AS ProductDescription,
      'Manufacturer ' || CAST({_BRAND_NO} % 5 AS VARCHAR) AS Manufacturer, p_brand AS BrandName,
      CASE WHEN p_size < 15 THEN 'Economy' WHEN p_size < 35 THEN 'Regular' ELSE 'Deluxe' END AS ClassName,
      'Style ' || CAST({draw('style', 4, 'p_partkey')} AS VARCHAR) AS StyleName,
      split_part(p_name, ' ', 1) AS ColorName, CAST(p_size AS VARCHAR) AS Size,
      CASE WHEN p_size < 25 THEN '0-24' ELSE '25+' END AS SizeRange, p_size * 0.5 AS Weight,
      'each' AS UnitOfMeasureName,
      CASE WHEN {draw('stock', 3, 'p_partkey')} = 0 THEN 'High' WHEN {draw('stock', 3, 'p_partkey')} = 1 THEN 'Mid' ELSE 'Low' END AS StockTypeName,
      CAST(CAST(CAST(p_retailprice AS DECIMAL(15,2)) * 0.004 AS DECIMAL(19,4)) * 0.6 AS DECIMAL(19,4)) AS UnitCost,
      CAST(CAST(p_retailprice AS DECIMAL(15,2)) * 0.004 AS DECIMAL(19,4)) AS UnitPrice,
      CAST(DATE '1994-01-01' + CAST({draw('avail', 730, 'p_partkey')} AS INTEGER) AS DATE) AS AvailableForSaleDate,
      CASE WHEN {draw('stop', 10, 'p_partkey')} = 0 THEN CAST(DATE '1999-01-01' + CAST({draw('stopday', 1500, 'p_partkey')} AS INTEGER) AS DATE) END AS StopSaleDate
    FROM part""", ()),
    "dim_product_subcategory": (f"""
    SELECT DISTINCT {_CAT_KEY} * 100 + {_BRAND_NO} AS ProductSubcategoryKey, p_type || ' ' || p_brand AS ProductSubcategoryName,
      {_CAT_KEY} AS ProductCategoryKey FROM part""", ()),
    "dim_product_category": (f"SELECT DISTINCT {_CAT_KEY} AS ProductCategoryKey, p_type AS ProductCategoryName FROM part", ()),
    "dim_store": (f"""
    SELECT *, CASE WHEN CloseDate IS NOT NULL THEN 'Lease expired' END AS CloseReason,
      '555-1' || {pad('StoreKey', 3)} AS StorePhone, '555-2' || {pad('StoreKey', 3)} AS StoreFax,
      CAST({draw('saddr', 900, 'StoreKey')} AS VARCHAR) || ' Market St' AS AddressLine1, CAST(NULL AS VARCHAR) AS AddressLine2,
      {pad(draw('zip', 100000, 'StoreKey'), 5)} AS ZipCode
    FROM (SELECT *, CAST(OpenDate + CAST({draw('remodel', 2000, 'StoreKey')} AS INTEGER) AS DATE) AS LastRemodelDate FROM (
      SELECT *, CASE WHEN {draw('close', 8, 'StoreKey')} = 0 THEN CAST(OpenDate + CAST(3650 + {draw('closeday', 3000, 'StoreKey')} AS INTEGER) AS DATE) END AS CloseDate
      FROM (SELECT CAST(s_suppkey AS BIGINT) AS StoreKey, CAST(s_nationkey AS INTEGER) AS GeographyKey, s_name AS StoreName,
        {pick(STORE_TYPES, draw('stype', 4, 's_suppkey'))} AS StoreType, s_name || ' store' AS StoreDescription,
        CAST({draw('manager', 100, 's_suppkey')} + 1 AS INTEGER) AS StoreManager,
        CAST({draw('staff', 60, 's_suppkey')} + 5 AS INTEGER) AS EmployeeCount,
        CASE WHEN {draw('area0', 20, 's_suppkey')} <> 0 THEN CAST({draw('area', 60000, 's_suppkey')} + 500 AS DOUBLE) END AS SellingAreaSize,
        CAST(DATE '1985-01-01' + CAST({draw('open', 3650, 's_suppkey')} AS INTEGER) AS DATE) AS OpenDate
      FROM supplier) a) b) c""", ()),
    "dim_promotion": (f"""
    SELECT PromotionKey, {pad('PromotionKey', 3)} AS PromotionLabel,
      CASE WHEN PromotionKey = 1 THEN 'No Discount' ELSE 'Discount ' || CAST(PromotionKey - 1 AS VARCHAR) || '%' END AS PromotionName,
      CASE WHEN PromotionKey = 1 THEN 'No Discount' ELSE 'Volume Discount' END AS PromotionDescription,
      CASE WHEN PromotionKey = 1 THEN 'No Discount' ELSE 'Seasonal Discount' END AS PromotionType,
      CASE WHEN PromotionKey = 1 THEN 'No Discount' ELSE 'Customer' END AS PromotionCategory,
      l_discount AS DiscountPercent, 1 AS MinQuantity, CAST(NULL AS INTEGER) AS MaxQuantity,
      CAST(DATE '1995-01-01' + CAST({draw('pstart', 365, 'PromotionKey')} AS INTEGER) AS DATE) AS StartDate,
      CASE WHEN {draw('pend', 3, 'PromotionKey')} <> 0 THEN CAST(DATE '1997-01-01' + CAST({draw('pendday', 2000, 'PromotionKey')} AS INTEGER) AS DATE) END AS EndDate
    FROM (SELECT DISTINCT l_discount, CAST(round(l_discount * 100) AS INTEGER) + 1 AS PromotionKey FROM lineitem) d""", ()),
    "dim_employee": (f"""
    SELECT EmployeeKey, CASE WHEN EmployeeKey // 10 > 0 THEN EmployeeKey // 10 END AS ParentEmployeeKey,
      'Employee' AS FirstName, CASE WHEN {draw('emid', 3, 'EmployeeKey')} = 0 THEN '' END AS MiddleName,
      {pad('EmployeeKey', 5)} AS LastName,
      CASE WHEN EmployeeKey // 10 = 0 THEN 'Director' ELSE 'Associate' END AS Title,
      'employee' || CAST(EmployeeKey AS VARCHAR) || '@example.com' AS EmailAddress,
      '555-3' || {pad('EmployeeKey', 4)} AS Phone,
      CASE WHEN {draw('egender', 2, 'EmployeeKey')} = 0 THEN 'M' ELSE 'F' END AS Gender,
      CASE WHEN {draw('emarital', 2, 'EmployeeKey')} = 0 THEN 'M' ELSE 'S' END AS MaritalStatus,
      {pick(DEPARTMENTS, draw('dept', 5, 'EmployeeKey'))} AS DepartmentName,
      {draw('dept', 5, 'EmployeeKey')} = 0 AS SalesPersonFlag,
      {draw('salaried', 2, 'EmployeeKey')} = 0 AS SalariedFlag,
      {draw('status', 10, 'EmployeeKey')} <> 0 AS CurrentFlag,
      CAST(10 + {draw('rate', 40, 'EmployeeKey')} AS DECIMAL(19,4)) AS BaseRate,
      CAST({draw('vacation', 100, 'EmployeeKey')} AS INTEGER) AS VacationHours, 2 AS PayFrequency,
      CAST(DATE '1996-01-01' + CAST({draw('hire', 4000, 'EmployeeKey')} AS INTEGER) AS DATE) AS HireDate,
      CAST(DATE '1996-01-01' + CAST({draw('hire', 4000, 'EmployeeKey')} AS INTEGER) AS DATE) AS StartDate,
      CAST(NULL AS DATE) AS EndDate,
      CAST(DATE '1950-01-01' + CAST({draw('ebirth', 15000, 'EmployeeKey')} AS INTEGER) AS DATE) AS BirthDate,
      CASE WHEN {draw('status', 10, 'EmployeeKey')} <> 0 THEN 'Current' END AS Status
    FROM (SELECT CAST(s_suppkey AS BIGINT) + 1 AS EmployeeKey FROM supplier) e""", ()),
    "order_bounds": ("SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders", ()),
    "dim_date": ("""
    SELECT Datekey,
      CASE WHEN dayofweek(Datekey) IN (0, 6) THEN 'WeekEnd' ELSE 'WorkDay' END AS IsWorkDay,
      CASE WHEN HolidayName IS NOT NULL THEN 1 ELSE 0 END AS IsHoliday, HolidayName,
      CASE WHEN month(Datekey) IN (12, 1, 2) THEN 'Winter' WHEN month(Datekey) IN (3, 4, 5) THEN 'Spring'
           WHEN month(Datekey) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS EuropeSeason,
      CASE WHEN month(Datekey) IN (11, 12) THEN 'Holiday Season' WHEN month(Datekey) IN (8, 9) THEN 'Back to School' ELSE 'None' END AS NorthAmericaSeason,
      CASE WHEN month(Datekey) IN (1, 2) THEN 'Spring Festival' WHEN month(Datekey) IN (10, 11) THEN 'Golden Week' ELSE 'None' END AS AsiaSeason
    FROM (SELECT Datekey, CASE WHEN month(Datekey) = 1 AND day(Datekey) = 1 THEN 'New Year''s Day'
                               WHEN month(Datekey) = 7 AND day(Datekey) = 4 THEN 'Independence Day'
                               WHEN month(Datekey) = 12 AND day(Datekey) = 25 THEN 'Christmas Day' END AS HolidayName
          FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Datekey FROM order_bounds) s) d""",
                 ("order_bounds",)),
    "dim_channel": (values_sql([(k, f"{k:02d}", n, f"{n} channel") for k, n in CHANNELS],
                               ["ChannelKey", "ChannelLabel", "ChannelName", "ChannelDescription"]), ()),
    "dim_scenario": (values_sql([(k, f"{k:02d}", n, f"{n} scenario") for k, n, _ in SCENARIOS],
                                ["ScenarioKey", "ScenarioLabel", "ScenarioName", "ScenarioDescription"]), ()),
    "dim_currency": (values_sql([(k, f"{k:03d}", c, d) for k, c, d in CURRENCIES],
                                ["CurrencyKey", "CurrencyLabel", "CurrencyName", "CurrencyDescription"]), ()),
    "fact_exchange_rate": (f"""
    SELECT CurrencyKey, CAST(d AS TIMESTAMP) AS DateKey, avg_rate AS AverageRate,
      avg_rate * CASE WHEN CurrencyKey IN (2, 3) THEN 1 + ({draw('fxe', 21, 'CurrencyKey', _DK)} - 10) / 1000.0 ELSE 1.0 END AS EndOfDayRate
    FROM (SELECT *, CASE WHEN CurrencyKey = 1 THEN 1.0 WHEN CurrencyKey = 2 THEN 0.85 WHEN CurrencyKey = 3 THEN 0.65 ELSE 0.0 END
                 + CASE WHEN CurrencyKey IN (2, 3) THEN ({draw('fx', 100, 'CurrencyKey', _DK)} - 50) / 1000.0 ELSE 0.0 END AS avg_rate
          FROM (SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS d
                FROM order_bounds) m
          CROSS JOIN (SELECT CurrencyKey FROM (VALUES {', '.join(f'({k})' for k, _, _ in CURRENCIES)}) t(CurrencyKey)) c) x""",
                           ("order_bounds",)),
    "fact_inventory": (f"""
    SELECT concat_ws('-', strftime(m, '%Y%m'), CAST(s AS VARCHAR), CAST(p AS VARCHAR)) AS InventoryKey,
      CAST(m AS TIMESTAMP) AS DateKey, CAST(s AS BIGINT) AS StoreKey, CAST(p AS BIGINT) AS ProductKey, 1 AS CurrencyKey,
      CAST(CASE WHEN mult < 2 THEN 0
                WHEN mult < 17 THEN floor(ss * ({draw('inv_lo', 100, *_INV_KEYS)} / 100.0))
                WHEN mult < 86 THEN ss + 1 + {draw('inv_mid', 3, *_INV_KEYS)} * ss
                WHEN mult < 99 THEN 4 * ss + 1 + {draw('inv_hi', 50, *_INV_KEYS)}
                ELSE 9 * ss END AS INTEGER) AS OnHandQuantity,
      CAST(trunc(q) AS BIGINT) AS OnOrderQuantity, ss AS SafetyStockQuantity,
      CAST(1.5 + {draw('inv_cost', 2000, *_INV_KEYS)} / 100 AS DECIMAL(19,4)) AS UnitCost,
      CAST({draw('inv_days', 365, *_INV_KEYS)} AS INTEGER) AS DaysInStock,
      CAST({draw('inv_min', 30, *_INV_KEYS)} AS INTEGER) AS MinDayInStock,
      CAST({draw('inv_min', 30, *_INV_KEYS)} + {draw('inv_max', 300, *_INV_KEYS)} AS INTEGER) AS MaxDayInStock,
      CASE WHEN {draw('inv_age0', 10, *_INV_KEYS)} <> 0 THEN CAST({draw('inv_age', 365, *_INV_KEYS)} AS INTEGER) END AS Aging
    FROM (SELECT *, CAST({draw('inv_ss', 40, *_INV_KEYS)} + 5 AS INTEGER) AS ss, {draw('inv_mult', 100, *_INV_KEYS)} AS mult
          FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, l_suppkey AS s, l_partkey AS p, sum(l_quantity) AS q
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) g) x""", ()),
    "fact_sales_quota": (f"""
    SELECT CAST(m AS TIMESTAMP) AS DateKey, StoreKey, ProductKey, 1 AS CurrencyKey, ChannelKey, sc.k AS ScenarioKey,
      CAST(q * sc.f AS DECIMAL(19,4)) AS SalesQuantityQuota, CAST(a * sc.f AS DECIMAL(19,4)) AS SalesAmountQuota,
      CAST(gm * sc.f AS DECIMAL(19,4)) AS GrossMarginQuota
    FROM (SELECT CAST(date_trunc('month', DateKey) AS DATE) AS m, StoreKey, ProductKey, ChannelKey,
                 sum(SalesQuantity) AS q, sum(SalesAmount) AS a, sum(SalesAmount - TotalCost) AS gm
          FROM fact_sales GROUP BY ALL) g
    CROSS JOIN (VALUES {', '.join(f'({k}, {f})' for k, _, f in SCENARIOS)}) sc(k, f)""", ("fact_sales",)),
    "ref_acquisition_channel": (values_sql(
        [(k, n, c, lo, hi, d) for k, n, c, lo, hi, d in ACQUISITION_CHANNELS],
        ["AcquisitionChannelKey", "ChannelName", "ChannelCategory", "EstimatedCACLow", "EstimatedCACHigh",
         "ChannelDescription"]), ()),
    "ref_payment_method": (values_sql(PAYMENT_METHODS, [
        "PaymentMethodKey", "PaymentMethodName", "PaymentCategory", "IsDigital", "PaymentDescription"]), ()),
    "ref_return_reason": (values_sql(RETURN_REASONS, [
        "ReturnReasonKey", "ReturnReasonCode", "ReturnReasonName", "ReturnReasonCategory", "IsOperationalFailure",
        "AppliesTo", "ReturnReasonDescription"]), ()),
}


def register(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (body, deps)


def with_ctes(query: str, *needed: str) -> str:
    """Prefix ``query`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + query
