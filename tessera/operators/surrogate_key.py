"""Distributed ROW_NUMBER() over a global order of text ids (a surrogate key).

``row_number() OVER (ORDER BY ...)`` without PARTITION BY makes Spark move
every row into one partition. Range partitioning needs sampled cuts, a job of
its own and a checkpoint to pin them. Here the cuts are fixed: ids are dealt
by their leading characters, which any order of texts keeps together.

1. Ids are counted by their longest prefix (``steps``), combined map-side.
2. Each prefix starts after the ids of its group under smaller prefixes: the
   counts are added up level by level, each under the next shorter prefix, so
   a window never holds more than the different continuations of a prefix.
3. A row's number is its prefix's start plus its place among the ids with that
   prefix; rows are shuffled once, by prefix.

All of it is one lazy plan: nothing runs while it is built, and two
evaluations agree. Ids must be unique in a group and not null. ``steps``
bounds both sides: ids with a common prefix as long as the last step are
numbered in one task, and continuations between two steps are in one window.
With the default, for ids of a letter code and digits, a window sees about one
in ten thousand of the ids; a step between makes that finer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_row_number(df: DataFrame, group: str | list[str], order: str, name: str | None = None, steps: tuple[int, ...] = (8, 22)) -> DataFrame:
    """``df`` with ``name``, its rows' numbers from 1 in the order of
    ``group`` and then the text ``order``; or, as ``with_row_number(df, columns,
    name)``, in the order of a list of columns."""
    if not isinstance(group, str):
        return _by_levels(df, group, group, group[-1], order)
    prefixes = [f"_p{n}" for n in steps]
    keyed = df.withColumns({p: F.left(F.col(order), F.lit(n)) for n, p in zip(steps, prefixes)})
    return _by_levels(keyed, [group, *prefixes], [group, prefixes[-1]], order, name).drop(*prefixes)


def _by_levels(df: DataFrame, levels: list[str], last: list[str], order: str, name: str) -> DataFrame:
    """Numbers ``df`` in the order of ``levels``, each under the ones before,
    and then ``order``; ``last`` are the levels that tell all others."""
    level = df.groupBy(*levels).agg(F.count(F.lit(1)).alias("_n"))
    earlier = lambda by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    counted = []
    for k in range(len(levels) - 1, 0, -1):
        before = F.coalesce(F.sum("_n").over(earlier(levels[:k]).orderBy(levels[k])), F.lit(0))
        counted.append((levels[:k], level.withColumn(f"_before{k}", before)))
        level = level.groupBy(*levels[:k]).agg(F.sum("_n").alias("_n"))
    # one row for each value of the first level: the groups are few (here, two channels)
    starts = level.select(levels[0], F.coalesce(F.sum("_n").over(earlier([]).orderBy(levels[0])), F.lit(0)).alias("_start"))
    for above, rows in reversed(counted):
        starts = rows.drop("_n").join(starts, above)
    total = sum((F.col(f"_before{k}") for k in range(1, len(levels))), F.col("_start"))
    starts = starts.select(*last, total.alias("_start"))
    place = F.row_number().over(Window.partitionBy(*last).orderBy(order))
    out = df.withColumn("_place", place).join(starts, last)
    return out.withColumn(name, (F.col("_start") + F.col("_place")).cast("long")).drop("_place", "_start")
