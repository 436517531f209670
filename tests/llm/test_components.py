import random

from pyspark.sql import functions as F

from tessera.llm.common import FREE_SHUFFLES, boxed, components, cut, link, maybe_in, salted, unboxed


def test_components_are_those_of_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(2000, 2000 + i) for i in range(1, 60)] + [(7, 7)]
    low = {v: v for e in edges for v in e}

    def find(v):
        while low[v] != v:
            v = low[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for a, b in edges for v in (a, b) if a != b}


def test_no_edges_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_loses_no_id(spark):
    ids = spark.range(0, 3000, 7)
    got = {r["x"] for r in maybe_in(spark.range(3000).withColumnRenamed("id", "x"), "x", ids).collect()}
    assert got >= set(range(0, 3000, 7)) and len(got) < 500
    assert maybe_in(spark.range(5).withColumnRenamed("id", "x"), "x", spark.range(0)).count() == 0


def test_boxed_rows_come_back(docs):
    df = docs([(1, "a"), (None, None)])
    assert unboxed(boxed(df), df).collect() == df.collect()


def shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_cut_leaves_no_shuffle_behind(spark):
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, "false")
    tables = [cut(df) for _ in range(3)]
    assert spark.conf.get(FREE_SHUFFLES, "false") == setting
    assert not shuffle_files(spark) - before
    assert [t.count() for t in tables] == [700] * 3


def test_links_across_components_under_hot_and_other_keys(spark):
    """Two groups of ids under each of two keys, one of them hot."""
    ids = {1: [64 * i for i in range(1, 90)], 2: [10_000 + i for i in range(40)]}
    rows = [(key, i) for key, some in ids.items() for i in some for _ in range(70 if key == 1 else 1)]
    df = spark.createDataFrame(rows, "key long, id long")
    hot = [r["key"] for r in salted(df).where("hot").select("key").distinct().collect()]
    assert hot == [1]
    odd = lambda c: F.when(F.col(c) < 10_000, F.floor(F.col(c) / 64)).otherwise(F.col(c)) % 2
    got = components(link(df, lambda pairs: pairs.where(odd("a") == odd("b")).select("a", "b"))).collect()
    assert {r["id"]: r["component"] for r in got} == {i: some[n % 2] for some in ids.values() for n, i in enumerate(some)}
