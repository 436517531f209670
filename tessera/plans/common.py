"""Shared pieces of the plans: scalar CTE twin and small helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.mart import SHIFT
from tessera.oracle.adapter_sql import register


register("scalars", f"""
  SELECT max_date, make_date(year(max_date) + {SHIFT}, 12, 31) AS reference_date,
         make_date(year(max_date) + {SHIFT}, 12, 31) AS as_of
  FROM (SELECT CAST(max(o_orderdate) AS DATE) AS max_date FROM orders) s""")


def share(df: DataFrame, count_col: str, out: str = "Pct", partition: list[str] | None = None,
          digits: int = 2) -> DataFrame:
    """Share of ``count_col`` within its partition (or the whole set) in percent.

    Used on already-aggregated frames (a handful of rows), so the
    un-partitioned window is cheap: SUM(COUNT(*)) OVER () of the reference.
    """
    w = Window.partitionBy(*(partition or []))
    tot = F.sum(count_col).over(w)
    return df.withColumn(out, F.round(F.col(count_col).cast("double") * 100.0 / tot, digits))


def sql_share(count_expr: str, partition: str = "", digits: int = 2) -> str:
    over = f"PARTITION BY {partition}" if partition else ""
    return f"round(CAST({count_expr} AS DOUBLE) * 100.0 / sum({count_expr}) OVER ({over}), {digits})"
