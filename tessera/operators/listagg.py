"""STRING_AGG(value, sep) WITHIN GROUP (ORDER BY ...) over data-sized groups.

A group's values are first gathered and sorted under (group, salt), then its
sorted parts are put together: a hot group's rows are spread over ``salts``
tasks, and only its sorted parts, one row each, meet in the task that makes
its text (a text is one cell, so that one cannot be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_listagg(df: DataFrame, by: list[str], value: str, order: list[str], out: str, sep: str = ", ", salts: int = 64) -> DataFrame:
    """``by, out``: the group's non-null values as text, joined by ``sep`` in
    the order of ``order`` and then the value. A group of nulls only has an
    empty text."""
    entry = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).cast("string").alias("_value")))
    salt = F.pmod(F.xxhash64(*order, value), F.lit(salts)).alias("_salt")
    parts = df.groupBy(*by, salt).agg(F.sort_array(F.collect_list(entry)).alias("_part"))
    whole = F.sort_array(F.flatten(F.collect_list("_part")))
    return parts.groupBy(*by).agg(F.array_join(F.transform(whole, lambda x: x["_value"]), sep).alias(out))
