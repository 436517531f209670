"""Named-metric reports (the reference's UNION ALL of one-number SELECTs).

Instead of scanning the table once per metric, all metrics are computed as
columns of a single aggregate and unpivoted into (name, value) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_rows(row: DataFrame, metrics: list[tuple[str, Column]], name_col: str = "Metric",
                value_col: str = "Value") -> DataFrame:
    """Evaluate ``metrics`` (name, expression over ``row``'s columns) and unpivot.

    ``row`` is a one-row frame (usually a cross join of one-row aggregates).
    """
    cols = [expr.cast("long").alias(f"m{i}") for i, (_, expr) in enumerate(metrics)]
    wide = row.select(*cols)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(name).alias(name_col), F.col(f"m{i}").alias(value_col))
        for i, (name, _) in enumerate(metrics)
    ]))
    return wide.select(stacked)


def sql_metric_rows(row_sql: str, metrics: list[tuple[str, str]], name_col: str = "Metric",
                    value_col: str = "Value") -> str:
    """DuckDB twin: ``row_sql`` gives one row, ``metrics`` name its columns."""
    names = ", ".join(f"'{name}'" for name, _ in metrics)
    values = ", ".join(f"CAST({col} AS BIGINT)" for _, col in metrics)
    return f'SELECT unnest([{names}]) AS "{name_col}", unnest([{values}]) AS {value_col} FROM ({row_sql}) one'


def missing_in(df: DataFrame, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether its ``key`` is missing in ``dim`` (unique there)."""
    known = dim.select(F.col(key).alias(f"_{flag}"), F.lit(False).alias(flag))
    return df.join(known, F.col(key) == F.col(f"_{flag}"), "left").drop(f"_{flag}").withColumn(flag, F.coalesce(flag, F.lit(True)))
