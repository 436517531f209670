"""P6/P7 return events: pipeline queries, the unioned returns view V14 and
checks Q39-Q50, Q66."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, shift
from tessera.operators import distinct_counts, metric_rows, missing_in, ordered_listagg, sql_metric_rows, with_row_number
from tessera.oracle.adapter_sql import register
from tessera.plans import gen
from tessera.plans.common import SHIFT, share, sql_share
from tessera.plans.registry import query
from tessera.sources.adapter import LINES_PER_ORDER

# --- fixed values: value-tier labels of the return reports --------------------
TIER_LABELS = ["1 - Low  (< $50)", "2 - Mid  ($50–$199)", "3 - High (>= $200)"]
# -----------------------------------------------------------------------------


def _cnt():
    return F.count(F.lit(1))


def _tier_label(amount):
    return (F.when(amount < 50, TIER_LABELS[0]).when(amount < 200, TIER_LABELS[1]).otherwise(TIER_LABELS[2]))


_SQL_TIER = (f"CASE WHEN ReturnAmount < 50 THEN '{TIER_LABELS[0]}' WHEN ReturnAmount < 200 THEN '{TIER_LABELS[1]}' "
             f"ELSE '{TIER_LABELS[2]}' END")


@query("P6_online_returns", "SELECT * FROM gen_online_returns", ("gen_online_returns",))
def p6(m):
    return m.get(gen.gen_online_returns)


@query("P7_store_returns", "SELECT * FROM gen_store_returns", ("gen_store_returns",))
def p7(m):
    return m.get(gen.gen_store_returns)


# ----------------------------------------------------------------- V14 vReturns
_V14_COLS = ["ReturnEventID", "ReturnDateKey", "ReturnDate", "OriginalSaleDateKey", "OriginalSaleDate",
             "CustomerKey", "StoreKey", "ProductKey", "ReturnReasonKey", "SalesOrderNumber", "SalesOrderLineNumber",
             "ReturnQuantity", "ReturnAmount", "RefundAmount", "IsRefunded", "ReturnLagDays", "ReturnChannel"]


def _v14_part(df: DataFrame, prefix: str, id_col: str, channel: str, online: bool) -> DataFrame:
    rd, od = shift(F.col("ReturnDate"), SHIFT), shift(F.col("OriginalSaleDate"), SHIFT)
    null_key = F.lit(None).cast("long")
    return df.select(
        F.concat(F.lit(prefix), F.col(id_col).cast("string")).alias("ReturnEventID"),
        date_key(rd).alias("ReturnDateKey"), rd.alias("ReturnDate"),
        date_key(od).alias("OriginalSaleDateKey"), od.alias("OriginalSaleDate"),
        (F.col("CustomerKey") if online else null_key).alias("CustomerKey"),
        (null_key if online else F.col("StoreKey")).alias("StoreKey"),
        "ProductKey", "ReturnReasonKey",
        (F.col("SalesOrderNumber") if online else F.lit(None).cast("string")).alias("SalesOrderNumber"),
        (F.col("SalesOrderLineNumber") if online else null_key).alias("SalesOrderLineNumber"),
        "ReturnQuantity", "ReturnAmount", "RefundAmount", "IsRefunded", "ReturnLagDays",
        F.lit(channel).alias("ReturnChannel"),
    )


def v_returns_unkeyed(m) -> DataFrame:
    """UNION ALL of both return tables with typed NULLs (no surrogate key)."""
    on = _v14_part(m.get(gen.gen_online_returns), "ONL-", "OnlineReturnEventID", "Online", True)
    ph = _v14_part(m.get(gen.gen_store_returns), "PHY-", "PhysicalReturnEventID", "Physical", False)
    return on.unionByName(ph)


def v_returns(m) -> DataFrame:
    """V14 fact.vReturns with ReturnEventKey = ROW_NUMBER over (channel, string id),
    computed without a single-partition exchange (see operators.surrogate_key)."""
    u = v_returns_unkeyed(m)
    k = with_row_number(u, "ReturnChannel", "ReturnEventID", "ReturnEventKey")
    return k.select("ReturnEventKey", *_V14_COLS)


def _sql_v14_part(src, prefix, id_col, channel, online):
    def dk(c):
        return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"

    return f"""SELECT '{prefix}' || CAST({id_col} AS VARCHAR) AS ReturnEventID, {dk('rd')} AS ReturnDateKey, rd AS ReturnDate,
      {dk('od')} AS OriginalSaleDateKey, od AS OriginalSaleDate,
      {'CustomerKey' if online else 'CAST(NULL AS BIGINT)'} AS CustomerKey,
      {'CAST(NULL AS BIGINT)' if online else 'StoreKey'} AS StoreKey, ProductKey, ReturnReasonKey,
      {'SalesOrderNumber' if online else 'CAST(NULL AS VARCHAR)'} AS SalesOrderNumber,
      {'SalesOrderLineNumber' if online else 'CAST(NULL AS BIGINT)'} AS SalesOrderLineNumber,
      ReturnQuantity, ReturnAmount, RefundAmount, IsRefunded, ReturnLagDays, '{channel}' AS ReturnChannel
    FROM (SELECT *, CAST(ReturnDate + INTERVAL {SHIFT} YEAR AS DATE) AS rd,
            CAST(OriginalSaleDate + INTERVAL {SHIFT} YEAR AS DATE) AS od FROM {src}) s"""


register("v_returns", f"""
  SELECT row_number() OVER (ORDER BY ReturnChannel, ReturnEventID) AS ReturnEventKey, *
  FROM ({_sql_v14_part('gen_online_returns', 'ONL-', 'OnlineReturnEventID', 'Online', True)}
        UNION ALL
        {_sql_v14_part('gen_store_returns', 'PHY-', 'PhysicalReturnEventID', 'Physical', False)}) u""",
         ("gen_online_returns", "gen_store_returns"))


@query("V14_returns", "SELECT * FROM v_returns", ("v_returns",))
def v14(m):
    return v_returns(m)


# ------------------------------------------------------------------- checks
def _summary(df: DataFrame) -> DataFrame:
    return df.agg(
        _cnt().alias("TotalRows"),
        F.count_if(F.col("IsRefunded")).alias("RefundedRows"),
        (F.count_if(F.col("IsRefunded")) * 100.0 / _cnt()).alias("RefundRatePct"),
        (F.sum("ReturnLagDays").cast("double") / _cnt()).alias("AvgReturnLagDays"),
        F.sum("ReturnAmount").cast("double").alias("TotalReturnAmount"),
        F.sum("RefundAmount").cast("double").alias("TotalRefundAmount"),
    )


_SQL_SUMMARY = """count(*) AS TotalRows, count(*) FILTER (WHERE IsRefunded) AS RefundedRows,
    CAST(count(*) FILTER (WHERE IsRefunded) AS DOUBLE) * 100.0 / count(*) AS RefundRatePct,
    CAST(sum(ReturnLagDays) AS DOUBLE) / count(*) AS AvgReturnLagDays,
    CAST(sum(ReturnAmount) AS DOUBLE) AS TotalReturnAmount, CAST(sum(RefundAmount) AS DOUBLE) AS TotalRefundAmount"""


@query("Q39_online_return_summary", f"SELECT {_SQL_SUMMARY} FROM gen_online_returns", ("gen_online_returns",))
def q39(m):
    return _summary(m.get(gen.gen_online_returns))


def _lag_by_tier(df):
    return df.groupBy(_tier_label(F.col("ReturnAmount")).alias("ValueTier")).agg(
        _cnt().alias("RowCount"), F.min("ReturnLagDays").alias("MinLagDays"),
        (F.sum("ReturnLagDays").cast("double") / _cnt()).alias("AvgLagDays"),
        F.max("ReturnLagDays").alias("MaxLagDays"),
        (F.sum("ReturnAmount").cast("double") / _cnt()).alias("AvgReturnAmount"))


def _sql_lag_by_tier(src):
    return f"""SELECT {_SQL_TIER} AS ValueTier, count(*) AS RowCount, min(ReturnLagDays) AS MinLagDays,
      CAST(sum(ReturnLagDays) AS DOUBLE) / count(*) AS AvgLagDays, max(ReturnLagDays) AS MaxLagDays,
      CAST(sum(ReturnAmount) AS DOUBLE) / count(*) AS AvgReturnAmount
    FROM {src} GROUP BY 1"""


@query("Q40_online_lag_by_tier", _sql_lag_by_tier("gen_online_returns"), ("gen_online_returns",))
def q40(m):
    return _lag_by_tier(m.get(gen.gen_online_returns))


def _reason_share(m, df):
    g = df.groupBy("ReturnReasonKey").agg(_cnt().alias("ReturnCount"))
    g = g.join(m.ref_return_reason.select("ReturnReasonKey", "ReturnReasonName", "AppliesTo"), "ReturnReasonKey")
    return share(g.drop("ReturnReasonKey"), "ReturnCount", "PctShare")


def _sql_reason_share(src):
    return f"""SELECT r.ReturnReasonName, r.AppliesTo, count(*) AS ReturnCount, {sql_share('count(*)')} AS PctShare
    FROM {src} e JOIN ref_return_reason r ON e.ReturnReasonKey = r.ReturnReasonKey
    GROUP BY r.ReturnReasonName, r.AppliesTo"""


@query("Q41_online_reason_share", _sql_reason_share("gen_online_returns"), ("gen_online_returns", "ref_return_reason"))
def q41(m):
    return _reason_share(m, m.get(gen.gen_online_returns))


@query("Q42_online_date_span", """SELECT min(OriginalSaleDate) AS MinOriginalSaleDate,
  max(OriginalSaleDate) AS MaxOriginalSaleDate, min(ReturnDate) AS MinReturnDate, max(ReturnDate) AS MaxReturnDate
  FROM gen_online_returns""", ("gen_online_returns",))
def q42(m):
    r = m.get(gen.gen_online_returns)
    return r.agg(F.min("OriginalSaleDate").alias("MinOriginalSaleDate"),
                 F.max("OriginalSaleDate").alias("MaxOriginalSaleDate"),
                 F.min("ReturnDate").alias("MinReturnDate"), F.max("ReturnDate").alias("MaxReturnDate"))


@query("Q43_online_refund_by_tier", f"""
  SELECT {_SQL_TIER} AS ValueTier, count(*) AS RowCount, count(*) FILTER (WHERE IsRefunded) AS RefundedCount,
    CAST(count(*) FILTER (WHERE IsRefunded) AS DOUBLE) * 100.0 / count(*) AS RefundRatePct,
    CAST(sum(RefundAmount) AS DOUBLE) AS TotalRefunded
  FROM gen_online_returns GROUP BY 1""", ("gen_online_returns",))
def q43(m):
    r = m.get(gen.gen_online_returns)
    return r.groupBy(_tier_label(F.col("ReturnAmount")).alias("ValueTier")).agg(
        _cnt().alias("RowCount"), F.count_if(F.col("IsRefunded")).alias("RefundedCount"),
        (F.count_if(F.col("IsRefunded")) * 100.0 / _cnt()).alias("RefundRatePct"),
        F.sum("RefundAmount").cast("double").alias("TotalRefunded"))


# --- fixed values: check labels ----------------------------------------------
Q44_LABELS = ["Orphan CustomerKeys", "Orphan ProductKeys", "Orphan ReturnReasonKeys",
              "Duplicate (OrderNumber, LineNumber) pairs", "ReturnDate after MaxDate", "ReturnLagDays < 1",
              "RefundAmount mismatch (IsRefunded=1 must have > 0)"]
Q50_LABELS = ["Orphan StoreKeys", "Orphan ProductKeys", "Orphan ReturnReasonKeys", "Duplicate SourceSalesKey values",
              "ReturnDate after MaxDate", "ReturnLagDays < 0", "RefundAmount mismatch (IsRefunded=1 must have > 0)"]
# -----------------------------------------------------------------------------


def _sql_integrity(table: str, dim: str, key: str, grain: str, least_lag: int, labels: list[str]) -> str:
    """All rules of a return table as columns of one aggregate."""
    return sql_metric_rows(f"""
      SELECT count(*) - count(d.{key}) AS c1, count(*) - count(p.ProductKey) AS c2, count(*) - count(r.ReturnReasonKey) AS c3,
        count(*) - count(DISTINCT {grain}) AS c4, sum(CASE WHEN e.ReturnDate > s.max_date THEN 1 ELSE 0 END) AS c5,
        sum(CASE WHEN e.ReturnLagDays < {least_lag} THEN 1 ELSE 0 END) AS c6,
        sum(CASE WHEN e.IsRefunded <> (e.RefundAmount > 0) THEN 1 ELSE 0 END) AS c7
      FROM {table} e LEFT JOIN {dim} d ON d.{key} = e.{key} LEFT JOIN dim_product p ON p.ProductKey = e.ProductKey
      LEFT JOIN ref_return_reason r ON r.ReturnReasonKey = e.ReturnReasonKey CROSS JOIN scalars s""",
                           [(label, f"c{i + 1}") for i, label in enumerate(labels)], "Check")


def _integrity(m, events: DataFrame, dim: DataFrame, key: str, order: Column, line: Column, least_lag: int, labels: list[str]) -> DataFrame:
    """The same in one pass: each dimension marks its rows by a left join, and
    pairs of order and line are counted as bits of the orders under each line
    number, which are few."""
    e = missing_in(missing_in(events, dim, key, "o1"), m.dim_product, "ProductKey", "o2")
    e = m.with_scalars(missing_in(e, m.ref_return_reason, "ReturnReasonKey", "o3"), "max_date")
    rules = [F.col("o1"), F.col("o2"), F.col("o3"), None, F.col("ReturnDate") > F.col("max_date"),
             F.col("ReturnLagDays") < least_lag, F.col("IsRefunded") != (F.col("RefundAmount") > 0)]
    row = distinct_counts(e, order, {"pairs": None}, {"n": _cnt(), **{f"c{i}": F.count_if(rule) for i, rule in enumerate(rules) if rule is not None}}, by=[line])
    row = row.withColumn("c3", F.col("n") - F.col("pairs"))
    return metric_rows(row, [(label, F.col(f"c{i}")) for i, label in enumerate(labels)], "Check", "Value")


@query("Q44_online_return_integrity", _sql_integrity("gen_online_returns", "dim_customer", "CustomerKey",
                                                     "(SalesOrderNumber, SalesOrderLineNumber)", 1, Q44_LABELS),
       ("gen_online_returns", "dim_customer", "dim_product", "ref_return_reason", "scalars"))
def q44(m):
    return _integrity(m, m.get(gen.gen_online_returns), m.dim_customer, "CustomerKey",
                      F.substring("SalesOrderNumber", 3, 30), F.col("SalesOrderLineNumber"), 1, Q44_LABELS)


@query("Q45_store_vs_online_returns", f"""
  SELECT 'PhysicalReturnEvents' AS TableName, {_SQL_SUMMARY} FROM gen_store_returns
  UNION ALL SELECT 'OnlineReturnEvents', {_SQL_SUMMARY} FROM gen_online_returns""",
       ("gen_store_returns", "gen_online_returns"))
def q45(m):
    p = _summary(m.get(gen.gen_store_returns)).select(F.lit("PhysicalReturnEvents").alias("TableName"), "*")
    o = _summary(m.get(gen.gen_online_returns)).select(F.lit("OnlineReturnEvents").alias("TableName"), "*")
    return p.unionByName(o)


@query("Q46_store_lag_by_tier", _sql_lag_by_tier("gen_store_returns"), ("gen_store_returns",))
def q46(m):
    return _lag_by_tier(m.get(gen.gen_store_returns))


@query("Q47_store_reason_share", _sql_reason_share("gen_store_returns"), ("gen_store_returns", "ref_return_reason"))
def q47(m):
    return _reason_share(m, m.get(gen.gen_store_returns))


@query("Q48_online_only_reasons_on_store", """
  SELECT count(*) AS OnlineOnlyReasonCount_MustBeZero FROM gen_store_returns e
  JOIN ref_return_reason r ON e.ReturnReasonKey = r.ReturnReasonKey WHERE r.AppliesTo = 'Online Only'""",
       ("gen_store_returns", "ref_return_reason"))
def q48(m):
    r = m.get(gen.gen_store_returns).join(
        m.ref_return_reason.where(F.col("AppliesTo") == "Online Only").select("ReturnReasonKey"), "ReturnReasonKey")
    return r.agg(_cnt().alias("OnlineOnlyReasonCount_MustBeZero"))


@query("Q49_top_stores_by_returns", """
  SELECT * FROM (
    SELECT e.StoreKey, s.StoreName, s.StoreType, count(*) AS ReturnCount,
      CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM gen_store_returns e2 JOIN dim_store s2 ON e2.StoreKey = s2.StoreKey) AS PctOfTotal,
      CAST(sum(e.ReturnAmount) AS DOUBLE) AS TotalReturnAmount
    FROM gen_store_returns e JOIN dim_store s ON e.StoreKey = s.StoreKey
    GROUP BY e.StoreKey, s.StoreName, s.StoreType) t
  ORDER BY ReturnCount DESC, StoreKey LIMIT 15""", ("gen_store_returns", "dim_store"))
def q49(m):
    """Top 15 stores by return count (the limit is the feature; ties broken by key).
    The share denominator is a one-row total, not a window over every store."""
    r = m.get(gen.gen_store_returns).join(m.dim_store.select("StoreKey", "StoreName", "StoreType"), "StoreKey")
    g = r.groupBy("StoreKey", "StoreName", "StoreType").agg(
        _cnt().alias("ReturnCount"), F.sum("ReturnAmount").cast("double").alias("TotalReturnAmount"))
    tot = g.agg(F.sum("ReturnCount").alias("tot"))
    g = g.crossJoin(F.broadcast(tot)).withColumn("PctOfTotal", F.col("ReturnCount").cast("double") * 100.0 / F.col("tot"))
    return (g.orderBy(F.desc("ReturnCount"), "StoreKey").limit(15)
            .select("StoreKey", "StoreName", "StoreType", "ReturnCount", "PctOfTotal", "TotalReturnAmount"))


@query("Q50_store_return_integrity", _sql_integrity("gen_store_returns", "dim_store", "StoreKey", "SourceSalesKey", 0, Q50_LABELS),
       ("gen_store_returns", "dim_store", "dim_product", "ref_return_reason", "scalars"))
def q50(m):
    k, room = F.col("SourceSalesKey"), F.lit(LINES_PER_ORDER).cast("decimal(13,0)")
    return _integrity(m, m.get(gen.gen_store_returns), m.dim_store, "StoreKey", F.call_function("div", k, room), (k % room).cast("long"), 0, Q50_LABELS)


@query("Q66_returns_null_audit", """
  SELECT ReturnChannel, count(*) AS RowCount, count(*) FILTER (WHERE CustomerKey IS NULL) AS NullCustomerKeys,
    count(*) FILTER (WHERE StoreKey IS NULL) AS NullStoreKeys, count(*) FILTER (WHERE SalesOrderNumber IS NULL) AS NullOrderNumbers,
    count(*) FILTER (WHERE OriginalSaleDateKey IS NULL) AS NullOriginalSaleDateKeys,
    min(ReturnDate) AS MinReturnDate, max(ReturnDate) AS MaxReturnDate, CAST(sum(RefundAmount) AS DOUBLE) AS TotalRefundAmount
  FROM v_returns GROUP BY ReturnChannel""", ("v_returns",))
def q66(m):
    """NULL audit by channel; reads the union without the surrogate key (not needed here)."""
    v = v_returns_unkeyed(m)
    return v.groupBy("ReturnChannel").agg(
        _cnt().alias("RowCount"), F.count_if(F.col("CustomerKey").isNull()).alias("NullCustomerKeys"),
        F.count_if(F.col("StoreKey").isNull()).alias("NullStoreKeys"),
        F.count_if(F.col("SalesOrderNumber").isNull()).alias("NullOrderNumbers"),
        F.count_if(F.col("OriginalSaleDateKey").isNull()).alias("NullOriginalSaleDateKeys"),
        F.min("ReturnDate").alias("MinReturnDate"), F.max("ReturnDate").alias("MaxReturnDate"),
        F.sum("RefundAmount").cast("double").alias("TotalRefundAmount"))


@query("A4_return_reasons_by_product", """
  SELECT e.ProductKey, count(*) AS ReturnCount, string_agg(DISTINCT r.ReturnReasonCode, ', ' ORDER BY r.ReturnReasonCode) AS ReasonCodes,
    string_agg(r.ReturnReasonCode, ', ' ORDER BY e.ReturnDate, e.ReturnEventID) AS ReasonHistory
  FROM v_returns e JOIN ref_return_reason r ON r.ReturnReasonKey = e.ReturnReasonKey GROUP BY e.ProductKey""", ("v_returns", "ref_return_reason"))
def a4(m):
    """Return reasons of every product: its different codes, and the code of
    each of its returns in order of date (STRING_AGG over data-sized groups)."""
    codes = m.ref_return_reason.select("ReturnReasonKey", "ReturnReasonCode")
    e = v_returns_unkeyed(m).select("ProductKey", "ReturnReasonKey", "ReturnDate", "ReturnEventID").join(codes, "ReturnReasonKey")
    kinds = e.groupBy("ProductKey", "ReturnReasonCode").agg(_cnt().alias("n")).groupBy("ProductKey").agg(  # at most 8 codes a product
        F.sum("n").alias("ReturnCount"), F.array_join(F.sort_array(F.collect_list("ReturnReasonCode")), ", ").alias("ReasonCodes"))
    return kinds.join(ordered_listagg(e, ["ProductKey"], "ReturnReasonCode", ["ReturnDate", "ReturnEventID"], "ReasonHistory"), "ProductKey")
