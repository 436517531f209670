"""Exact distinct counts of integer keys by bit sets.

Keys are cut into words of 64 neighbours: ``key >> 6`` names the word and the
low six bits a bit of it. Tasks first OR the bits of the keys they read, so
what is shuffled is at most one (word, bits) row for each word and task, 64
times fewer than keys where these are dense and never more than one for each
different key where they are not; a hot key is one bit of one row. Several
counts under different conditions, and plain counts, share that one exchange,
where COUNT(DISTINCT) of several columns expands every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_words(df: DataFrame, key: Column, sets: dict[str, Column | None], totals: dict[str, Column] | None = None,
              by: list[Column] | None = None) -> DataFrame:
    """``_by0.., _word`` and for each name in ``sets`` the bits of the keys in
    rows that meet its condition (None: all rows), for each in ``totals`` an aggregate."""
    k = key.cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    groups = [b.alias(f"_by{i}") for i, b in enumerate(by or [])]
    bits = [F.bit_or(bit if cond is None else F.when(cond, bit)).alias(name) for name, cond in sets.items()]
    return df.groupBy(*groups, F.shiftright(k, 6).alias("_word")).agg(*bits, *[agg.alias(name) for name, agg in (totals or {}).items()])


def distinct_counts(df: DataFrame, key: Column, distinct: dict[str, Column | None], totals: dict[str, Column] | None = None,
                    by: list[Column] | None = None) -> DataFrame:
    """One row: for each name in ``distinct`` the number of different non-null
    integer keys (``by``: pairs of those and a key) of rows that meet its
    condition (None: all rows), and for each in ``totals`` the sum of an
    aggregate such as a count."""
    words = key_words(df, key, distinct, totals, by)
    known = F.lit(True)
    for i in range(len(by or [])):
        known = known & F.col(f"_by{i}").isNotNull()  # a pair with a null is no pair
    return words.agg(*[F.coalesce(F.sum(F.when(known, F.bit_count(name))), F.lit(0)).cast("long").alias(name) for name in distinct],
                     *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in totals or {}])
