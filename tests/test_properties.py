"""Property tests (hypothesis) for the operators against brute force."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import argmax_key, with_row_number

scores = st.lists(st.tuples(*[st.integers(0, 5)] * 4), min_size=1, max_size=30)


@settings(max_examples=10, deadline=None)
@given(scores)
def test_argmax_equals_python_max(spark, rows):
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in rows], "a double, b double, c double, d double")
    got = [r.k for r in df.select(argmax_key({1: F.col("a"), 2: F.col("b"), 3: F.col("c"), 4: F.col("d")})
                                 .alias("k")).collect()]
    exp = [max(range(4), key=lambda i: (r[i], -i)) + 1 for r in rows]
    assert got == exp


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1000)), min_size=1, max_size=60, unique=True),
       st.integers(1, 6))
def test_row_number_is_a_dense_order_rank(spark, rows, parts):
    df = spark.createDataFrame(rows, "g long, v long").repartition(parts)
    got = with_row_number(df, ["g", "v"], "rn").toPandas().sort_values("rn")
    exp = pd.DataFrame(sorted(rows), columns=["g", "v"])
    assert list(got["rn"]) == list(range(1, len(rows) + 1))
    assert got[["g", "v"]].values.tolist() == exp.values.tolist()
