"""Hand-made edge rows (FIXTURES section 4): NULLs falling to ELSE, missing
lookups, blank names, zero-value orders, single-year data, band cuts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.mart import Mart
from tessera.plans import checks_marts, checks_sales_gen, dims, gen
from tests.conftest import SF_SMALL


@pytest.fixture()
def m(spark):
    return Mart(spark, SF_SMALL)


def frame(spark, template, rows):
    """Rows (dicts of overrides) on top of the first row of a real table."""
    base = template.limit(1).collect()[0].asDict()
    return spark.createDataFrame([Row(**{**base, **r}) for r in rows], template.schema)


def test_customer_edges(spark, m):
    rows = [
        {"CustomerKey": 1, "GeographyKey": 999, "CustomerType": "Person", "MiddleName": " ",
         "BirthDate": dt.date(1980, 6, 1), "Gender": "M"},                      # no geography, blank middle name
        {"CustomerKey": 2, "CustomerType": "Company", "BirthDate": None, "Gender": "F"},  # company, no birth date
        {"CustomerKey": 3, "YearlyIncome": None, "MiddleName": None},
    ]
    m.__dict__["dim_customer"] = frame(spark, Mart(spark, SF_SMALL).dim_customer, rows)
    out = {r.CustomerKey: r for r in m.get(dims.v_customer).collect()}
    assert out[1].CustomerContinent == "Unknown" and out[1].CustomerCity == "Unknown"
    assert "  " not in out[1].FullName and out[1].FullName.startswith("Customer ")
    assert out[2].Gender == "N/A" and out[2].Age is None and out[2].AgeGroup is None and out[2].LifeStage is None
    assert out[3].IncomeGroup is None
    acq = {r.CustomerKey for r in m.get(gen.gen_customer_acquisition).collect()}
    assert 2 not in acq and 1 in acq  # companies / NULL birth dates are not acquired


def test_nulls_fall_to_else(spark, m):
    fresh = Mart(spark, SF_SMALL)
    m.__dict__["dim_store"] = frame(spark, fresh.dim_store, [{"StoreKey": 1, "SellingAreaSize": None}])
    m.__dict__["dim_promotion"] = frame(spark, fresh.dim_promotion, [{"PromotionKey": 1, "DiscountPercent": None}])
    m.__dict__["dim_employee"] = frame(spark, fresh.dim_employee,
                                       [{"EmployeeKey": 1, "HireDate": None, "Status": "Current"}])
    assert m.get(dims.v_store).first().StoreSizeCategory == "Flagship"
    assert m.get(dims.v_promotion).first().DiscountTier == "Aggressive"
    assert m.get(dims.v_employee).first().SeniorityTier == "10+ Years"


def test_missing_category_gives_null_breadcrumb(spark, m):
    fresh = Mart(spark, SF_SMALL)
    m.__dict__["dim_product"] = frame(spark, fresh.dim_product, [{"ProductKey": 1, "ProductSubcategoryKey": 987654}])
    r = m.get(dims.v_product).first()
    assert r.CategoryName is None and r.ProductBreadcrumb is None


def test_currency_rate_edges(spark, m):
    fresh = Mart(spark, SF_SMALL)
    rows = [{"CurrencyKey": 1, "AverageRate": 1.0, "EndOfDayRate": 1.0},
            {"CurrencyKey": 4, "AverageRate": 0.0, "EndOfDayRate": 0.0},
            {"CurrencyKey": 2, "AverageRate": 1.0, "EndOfDayRate": 1.006},
            {"CurrencyKey": 3, "AverageRate": 1.0, "EndOfDayRate": 0.994}]
    m.__dict__["fact_exchange_rate"] = frame(spark, fresh.fact_exchange_rate, rows)
    out = {r.CurrencyKey: r for r in m.get(checks_marts.v_exchange_rate).collect()}
    assert out[1].IsBaseCurrency and out[1].RateDirection == "Stable"
    assert not out[4].IsBaseCurrency and out[4].RateDirection == "Stable"
    assert out[2].RateDirection == "Appreciating" and out[3].RateDirection == "Depreciating"


def test_zero_value_order_is_legal(spark, m):
    df = spark.createDataFrame([("SO1", 1, 20000101, Decimal("0")), ("SO2", 7, 20000101, Decimal("10"))],
                               "SalesOrderNumber string, PaymentMethodKey int, OrderDateKey int, OrderValue decimal(19,4)")
    m.__dict__.setdefault("_memo", {})[gen.gen_order_payment.__module__ + ".gen_order_payment"] = df
    checks = {r.Check: r.Value for r in checks_sales_gen.q20(m).collect()}
    assert checks["NULL or negative OrderValue"] == 0
    assert checks["Missing BNPL assignments (Key=7, expect >0)"] == 0


def test_single_year_progress_is_half(spark):
    df = spark.createDataFrame([(2001, 2001, 2001)], "y int, lo int, hi int")
    assert df.select(gen._year_progress(F.col("y"), F.col("lo"), F.col("hi")).alias("p")).first().p == 0.5


def test_order_value_cuts_are_strict(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("100", "100.0001", "200", "300", "500", "500.0001")],
                               "OrderValue decimal(19,4)")
    cuts, other = gen.PM_VALUE[4]  # >500 1.5, >200 1.2, else 0.6
    got = [r.f for r in df.select(gen._bands_gt(F.col("OrderValue"), cuts, other).alias("f")).collect()]
    assert got == [0.6, 0.6, 0.6, 1.2, 1.2, 1.5]
