"""Fact views V12-V13 (sales) - narrow projections over the source facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, shift
from tessera.oracle.adapter_sql import register
from tessera.plans.common import SHIFT
from tessera.plans.registry import query

_MEAS = ["SalesQuantity", "SalesAmount", "ReturnQuantity", "ReturnAmount", "DiscountQuantity",
         "DiscountAmount", "TotalCost", "UnitCost", "UnitPrice"]


def _shifted(col: str):
    return shift(F.col(col).cast("date"), SHIFT)


def _v12(f: DataFrame, keyed: bool) -> DataFrame:
    d = _shifted("DateKey")
    return f.select(
        *(["OnlineSalesKey"] if keyed else []),
        date_key(d).alias("DateKey"),
        d.alias("OrderDate"),
        "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey", "CustomerKey",
        "SalesOrderNumber", *(["SalesOrderLineNumber"] if keyed else []),
        *_MEAS,
        (F.col("SalesAmount") - F.col("TotalCost")).alias("GrossProfit"),
    )


def v_online_sales(m) -> DataFrame:
    """V12 fact.vOnlineSales: shifted date-key pair, keys, measures, GrossProfit."""
    return _v12(m.fact_online_sales, True)


def v_online_sales_lines(m) -> DataFrame:
    """V12 without the line keys: what aggregating reports read."""
    return _v12(m.online_lines, False)


def _v13(f: DataFrame, keyed: bool) -> DataFrame:
    d = _shifted("DateKey")
    return f.select(
        *(["SalesKey"] if keyed else []),
        date_key(d).alias("DateKey"),
        d.alias("SaleDate"),
        "ChannelKey", "StoreKey", "ProductKey", "PromotionKey", "CurrencyKey",
        *_MEAS,
        (F.col("SalesAmount") - F.col("TotalCost")).alias("GrossProfit"),
    )


def v_store_sales(m) -> DataFrame:
    """V13 fact.vStoreSales: same at store grain with ChannelKey."""
    return _v13(m.fact_sales, True)


def v_store_sales_lines(m) -> DataFrame:
    """V13 without the line key."""
    return _v13(m.store_lines, False)


_SQL_DK = f"CAST(CAST(DateKey AS DATE) + INTERVAL {SHIFT} YEAR AS DATE)"
_SQL_MEAS = ", ".join(_MEAS)
register("v_online_sales", f"""
  SELECT OnlineSalesKey, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DateKey, d AS OrderDate,
    StoreKey, ProductKey, PromotionKey, CurrencyKey, CustomerKey, SalesOrderNumber, SalesOrderLineNumber,
    {_SQL_MEAS}, SalesAmount - TotalCost AS GrossProfit
  FROM (SELECT *, {_SQL_DK} AS d FROM fact_online_sales) f""", ("fact_online_sales",))
register("v_store_sales", f"""
  SELECT SalesKey, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DateKey, d AS SaleDate,
    ChannelKey, StoreKey, ProductKey, PromotionKey, CurrencyKey, {_SQL_MEAS}, SalesAmount - TotalCost AS GrossProfit
  FROM (SELECT *, {_SQL_DK} AS d FROM fact_sales) f""", ("fact_sales",))


@query("V12_online_sales", "SELECT * FROM v_online_sales", ("v_online_sales",))
def q_v12(m):
    return m.get(v_online_sales)


@query("V13_store_sales", "SELECT * FROM v_store_sales", ("v_store_sales",))
def q_v13(m):
    return m.get(v_store_sales)
