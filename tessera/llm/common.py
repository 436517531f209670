"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.config import ensure_checkpoint_dir

# The bitmap of `maybe_in` has this many bits whatever the input's size (512 KB as 64-bit words).
BITMAP_BITS = 1 << 21
# The setting under which a finished execution frees the files that it shuffled.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Where `alone` notes what `cut` writes.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)
# At most so many hot keys are broadcast by `salted` (16 bytes each).
HOT_KEYS = 10_000
# Hot keys are found on one id in so many.
SAMPLE_EVERY = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def during(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within it the session has these settings."""
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, as compressed Parquet and in one
    pass; a lost executor costs a re-read of the files. What was shuffled for
    it is freed at once, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``cut`` of what ``make`` returns. The tables that were cut on the way to
    it are removed, so ``make`` must hand none of them out in another way."""
    written: list[str] = []
    token = _WRITTEN.set(written)
    try:
        df = make()
        _WRITTEN.reset(token)
        return cut(df)
    except BaseException:
        if _WRITTEN.get() is written:
            _WRITTEN.reset(token)
        raise
    finally:
        for path in written:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``id, component`` for
    each id on an edge, ``component`` the smallest id reachable.

    Alternating large-star and small-star steps: every step replaces a
    neighbourhood by links to its minimum, so the number of rounds grows with
    the logarithm of a component's size and no step lists a neighbourhood.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        e = cut(large.join(low, "a").select(pairs.alias("p")).select("p.*").where("a <> b").distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                e.select("b", "b").distinct())
        seen = now


def maybe_in(df: DataFrame, col: str, ids: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Rows of ``df`` whose ``col`` may occur in ``ids(id)``: never loses one.

    A Bloom filter with one hash in a bitmap of fixed size, broadcast as one
    row, so that a following exact join shuffles few other rows. A full
    bitmap lets everything through; the exact join decides either way.
    """
    h = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select(F.shiftright(h, 5).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (h % 32).cast("int")).alias("v"))
    words = words.groupBy("w").agg(F.bit_or("v").alias("v"))
    every = df.sparkSession.range(bits // 32).join(words, F.col("id") == F.col("w"), "left")
    listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("v", F.lit(0).cast("long")).alias("v"))))
    row = cut(every.agg(F.transform(listed, lambda x: x["v"]).alias("_bitmap")))
    g = F.pmod(F.xxhash64(F.col(col)), F.lit(bits))
    word = F.get("_bitmap", F.shiftright(g, 5).cast("int"))
    hit = F.call_function("shiftright", word, (g % 32).cast("int")).bitwiseAND(F.lit(1)) == 1
    return df.join(F.broadcast(row), hit, "left_semi")


def in_sample(col: str, every: int = SAMPLE_EVERY) -> Column:
    """Whether an id is one of those on which hot keys are found."""
    return F.pmod(F.xxhash64(col), F.lit(every)) == 0


def salted(post: DataFrame, every: int = SAMPLE_EVERY, part: int = 4096, sample: DataFrame | None = None) -> DataFrame:
    """Adds ``salt`` to ``post(key, id)``: 0, but spread over ids for keys with
    over about ``part`` rows, so that no group reaches one task whole, and
    ``hot`` for these keys.

    Hot keys are found on one id in ``every`` (``sample``, if given, has these
    rows of ``post``, for one that costs much to make). A key that this misses is only
    dealt less evenly; results do not depend on the salt.
    """
    hot = (post if sample is None else sample).where(in_sample("id", every)).groupBy("key").count()
    hot = hot.where(F.col("count") * every >= part).orderBy(F.desc("count"), "key").limit(HOT_KEYS)
    hot = hot.select("key", F.ceil(F.col("count") * every / F.lit(part)).alias("_parts"))
    return post.join(F.broadcast(hot), "key", "left").withColumns({
        "salt": F.coalesce(F.pmod(F.xxhash64("id", F.lit(7)), F.col("_parts")), F.lit(0).cast("long")),
        "hot": F.col("_parts").isNotNull()}).drop("_parts")


def link(post: DataFrame, verify: Callable[[DataFrame], DataFrame], best: bool = False,
         near: Callable[[Column, Column], Column] | None = None, carry: bool = True, enough: Column | None = None, also: str | None = None,
         sample: DataFrame | None = None, told_apart: tuple[DataFrame, Column] | None = None, band: Callable[[Column], Column] | None = None) -> DataFrame:
    """Links ``a, b`` that connect every pair which shares a key and verifies.

    ``post(key, id)`` are the ids under each key; ``verify`` takes candidate
    pairs ``a, b, shared`` (number of keys shared) and returns those linked.
    With ``near``, ``post`` also has a ``mark``; keys under which two marks are
    not near do not count, and with ``carry`` pairs also have their largest
    marks ``ma, mb``. ``also`` names one more column that ``near`` is told of. ``enough`` says of a pair's columns whether it shares
    enough keys to be verified; ``sample`` goes to `salted`. ``told_apart`` is a table with more
    columns for each ``id`` and the condition on two rows ``x, y`` of it under which they may
    be linked at all: too wide for every key, it is asked in step 2 alone. ``band`` makes a whole
    number of ``also`` that differs by at most 1 between near ids: others do not meet in step 2.
    Copies are not expanded into all pairs:

    1. star: each id is compared with the smallest id under each of its keys
       (``best``: only the one it shares most keys with);
    2. cross: under keys that then still hold several components, ids of
       different components are compared, all of them.

    Keys of two ids, most of all that chance makes, take part in the second
    step only with ``best``, and as the pairs that they are. So two ids that
    share (enough) keys and verify end up in one component.
    """
    w = Window.partitionBy("key", "salt")
    rows = salted(post, sample=sample).withColumn("n", F.count("*").over(w))
    marks = ["ma", "mb"] if near and carry else []
    told = ["mark", *([also] if also else [])]
    if near:
        rows = rows.withColumn("p", F.min(F.struct("id", *told)).over(w)).select("key", "salt", "hot", "id", *told, "n", F.col("p.id").alias("piv"), *[F.col(f"p.{c}").alias(f"piv_{c}") for c in told])
        rows = rows.withColumn("close", near(*[F.col(f"{p}{c}") for c in told for p in ("", "piv_")]))
        # a mark need not be near itself: two ids are judged by the other one
        rows = rows.withColumn("pair", F.max(F.col("close") & (F.col("id") != F.col("piv"))).over(w))
    else:
        rows = rows.withColumn("piv", F.min("id").over(w)).withColumns({"close": F.lit(True), "pair": F.lit(True)})
    # a key with two ids that are not near has no candidate; of a hot key, n counts a part only
    rows = rows.withColumn("two", ~F.col("hot") & (F.col("n") == 2))
    unused = [] if marks else ["piv_mark", f"piv_{also}"]
    multi = cut(rows.where("hot or n > 2 or (two and pair)").drop("n", "salt", "pair", *unused))

    def candidates(pairs: DataFrame) -> DataFrame:
        found = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), *[F.max(m).alias(m) for m in marks])
        return found if enough is None else found.where(enough)

    stars = multi.where("id <> piv and close")
    stars = stars.select(F.col("id").alias("a"), F.col("piv").alias("b"), "two", *([F.col("mark").alias("ma"), F.col("piv_mark").alias("mb")] if marks else []))
    first = candidates(stars.drop("two"))
    if best:
        rest = [c for c in first.columns if c != "a"]
        first = first.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("last"), *rest[2:], "b")).alias("p")).select("a", *[f"p.{c}" for c in rest])
    one = alone(post.sparkSession, lambda: verify(first))
    comp = alone(post.sparkSession, lambda: components(one))
    rows = multi.where("not two").drop("piv", "piv_mark", f"piv_{also}", "close", "two").join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    # Rows are shuffled by key once; those of hot keys, of which there are few keys, not at all.
    by_key = Window.partitionBy("key")
    cold = rows.where("not hot").select("*", *(c.over(by_key).alias(n) for c, n in ((F.min("comp"), "lo"), (F.max("comp"), "hi")))).where("lo < hi")
    hot = rows.where("hot")
    mixed = hot.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rows = cut(cold.drop("lo", "hi").unionByName(hot.join(F.broadcast(mixed), "key", "left_semi")).drop("hot"))
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") < F.col("y.comp"))
    if near:
        apart = apart & near(*[F.col(f"{p}.{c}") for c in told for p in ("x", "y")])
    if told_apart:
        about, may = told_apart
        rows, apart = rows.join(about, "id"), apart & may
    if band:  # two ids meet in the cell of the larger of their bands
        rows = rows.withColumn("band", band(F.col(also))).withColumn("cell", F.explode(F.array("band", F.col("band") + 1)))
        apart = (F.col("x.cell") == F.col("y.cell")) & (F.col("x.cell") == F.greatest("x.band", "y.band")) & apart
    up = F.col("x.id") > F.col("y.id")
    turned = lambda c: [F.when(up, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")), F.when(up, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}"))]
    named = zip(["a", "b", *marks], turned("id") + (turned("mark") if marks else []))
    pairs = rows.alias("x").join(rows.alias("y"), apart).select(*[c.alias(n) for n, c in named])
    if best:
        pairs = pairs.unionByName(stars.where("two").drop("two"))
    pairs = candidates(pairs)
    if best:  # of one component by now
        for c in ("a", "b"):
            pairs = pairs.join(comp.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")), c, "left")
        pairs = pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")
    return one.unionByName(alone(post.sparkSession, lambda: verify(pairs)))


def boxed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: all columns of ``docs`` in one struct, so that
    no name of an operator's own meets one of them, and the two it works on."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def unboxed(df: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` again; with ``text``, that text and, if there
    is a column ``n_chars``, its length."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text)}
    return df.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col("row").getField(f.name)).alias(f.name) for f in docs.schema])
