"""Jaccard self-join on word n-grams by a prefix filter.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. All
sets are kept in one global order, rarest first: shingles that repeat much in
some batch of documents come last, by count, all others before them by hash.
A pair's texts meet in one task; their overlap is counted in each of eight hash
ranges (fragments) separately and summed per pair, by Spark.

Which pairs are counted follows from the order too. Two sets that reach the
threshold share a shingle of their prefixes, the first ``n - ceil(t n) + 1``
of each (and ``l`` shingles if both prefixes are ``l - 1`` longer), whatever
the order; with the rarest first these buckets are small. `common.link` takes
the prefix shingles as keys: copies are compared with one representative, and
only under keys where several components are left are all pairs between
components counted. So no link between components is lost, and groups of
copies are never expanded into pairs. Equal sets are linked by their hash
(128 bits and the size) without a count.

Words are split at white space (space, tab to carriage return) and A-Z lower-
cased. With fewer words than five the whole sequence is the one shingle.

Cases: a null text, or one without words, has an empty set and is linked with
nothing. Rows that repeat a doc_id are compared each and share a component.
Rows with a null doc_id are linked with nothing and have a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alone, boxed, components, cut, in_sample, link, maybe_in, unboxed

SLICE = 1 << 20  # bytes hashed at once
HOT_SHINGLES = 500_000  # at most so many are ranked by count; the others by hash
BATCH, HOT_IN_BATCH = 1 << 21, 3  # shingles in a batch, and occurrences there that make one hot
MEETINGS, MEETING_EVERY = 3, 20  # `l` is 1, and 1 more for every 20 shingles, to 3
FRAGMENTS = 8
PART = 256  # members of a star compared in one group
AT_ONCE = 500_000  # so many pairs of ids (24 bytes each) are broadcast to the texts; for more, the texts are shuffled to them

_RNG = np.random.default_rng(20)
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_STEP = np.full(SLICE, _BASE, np.uint64)
_STEP[0] = 1
with np.errstate(over="ignore"):
    _POWER = np.cumprod(_STEP)
    _STEP[1:] = pow(_BASE, -1, 1 << 64)
    _INVERSE = np.cumprod(_STEP)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of some UTF-8 text.

    A word's hash is a polynomial over its bytes, from running sums over a
    slice; slices end at white space, a word beyond that is added up.
    """
    hashes, starts, at = [], [], 0
    while at < len(body):
        end = min(len(body), at + SLICE)
        if end < len(body):
            back = max(body.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if back < at:  # one word fills the slice: take it whole, in slices
                end = next((i for i in range(end, len(body)) if _SPACE[body[i]]), len(body))
                hashes.append(np.array([_long_word(body[at:end])], np.uint64))
                starts.append(np.array([at]))
                at = end
                continue
            end = back + 1
        raw = np.frombuffer(body, np.uint8, end - at, at)
        gap = _SPACE[raw]
        edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * _POWER[: len(raw)], out=total[1:])
        hashes.append(_mix((total[last] - total[first]) * _INVERSE[first]))
        starts.append(first + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _long_word(word: bytes) -> int:
    total, scale = 0, 1
    for at in range(0, len(word), SLICE):
        raw = np.frombuffer(word, np.uint8, min(SLICE, len(word) - at), at)
        total += scale * int((_BYTES[raw] * _POWER[: len(raw)]).sum(dtype=np.uint64))
        scale = scale * pow(_BASE, len(raw), 1 << 64) % (1 << 64)
    return int(_mix(np.array([total % (1 << 64)], np.uint64))[0])


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, some texts at a time."""
    few, size = [], 0
    for t in texts:
        few.append(t)
        size += len(t or "")
        if size >= 2 * SLICE:
            yield from _sets(few, words)
            few, size = [], 0
    yield from _sets(few, words)


def _sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        bodies = [(t or "").encode("utf-8", "replace") for t in texts]
        ends = np.cumsum([len(b) + 1 for b in bodies])
        h, at = word_hashes(b"\n".join(bodies))
        stop = np.searchsorted(at, ends)
        weights = [np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(words)]
        n = max(0, len(h) - words + 1)
        grams = np.zeros(n, np.uint64)
        for j, w in enumerate(weights):
            grams += h[j:j + n] * w
        grams = _mix(grams)
        start = 0
        for end in stop:
            if end - start >= words:
                yield np.unique(grams[start:end - words + 1])
            elif end > start:
                short = np.uint64(end - start) + (h[start:end] * np.array(weights[: end - start], np.uint64)).sum(dtype=np.uint64)
                yield _mix(np.array([short], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            start = end


def _hot(words: int):
    """Shingles that repeat in a batch of documents, with counts."""

    def much(sets):
        h, n = np.unique(np.concatenate(sets), return_counts=True)
        hot = n >= HOT_IN_BATCH
        return pa.RecordBatch.from_arrays([pa.array(h[hot].view(np.int64)), pa.array(n[hot], pa.int64())], names=["shingle", "n"])

    def run(batches):
        sets, size = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                sets.append(s)
                size += len(s)
                if size >= BATCH:
                    yield much(sets)
                    sets, size = [], 0
        if sets:
            yield much(sets)

    return run


def prefix_length(n: int, num: int, den: int) -> int:
    """Shingles of the prefix of a set of ``n``."""
    return n - -(-num * n // den) + 1 + min(MEETINGS - 1, n // MEETING_EVERY)


def _meetings(x: Column, y: Column) -> Column:
    """Shingles that two sets of these sizes share in their prefixes at least."""
    return 1 + F.least(F.lit(MEETINGS - 1), F.floor(F.least(x, y) / MEETING_EVERY))


def _may_reach(num: int, den: int):
    """Whether two sets that share a shingle may reach the threshold if it is
    among the first ``l`` shared, from their marks (size and place of the shingle)."""

    def near(x: Column, y: Column) -> Column:
        size, left = (lambda m: F.shiftright(m, 32)), (lambda m: F.shiftright(m, 32) - m.bitwiseAND(F.lit((1 << 32) - 1)))
        most = F.least(left(x), left(y)) + _meetings(size(x), size(y)) - 1
        return most * den >= (size(x) + size(y) - most) * num

    return near


def _mark(s: np.ndarray) -> tuple[int, int, int]:
    """Size and 128-bit hash of a set."""
    with np.errstate(over="ignore"):
        return len(s), *(int(x.view(np.int64)) for x in (s.sum(dtype=np.uint64), (_mix(s) * s).sum(dtype=np.uint64)))


def _marks(words: int):
    """``doc_id, n, h1, h2``."""

    def run(batches):
        for batch in batches:
            marks = [_mark(s) for s in shingle_sets(batch.column("text").to_pylist(), words)]
            cols = zip(*marks) if marks else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", "n", "h1", "h2"])

    return run


def _prefixes(words: int, num: int, den: int, hot):
    """``doc_id, n, keys`` of documents with shingles; only once in a task for equal sets."""

    def run(batches):
        ranked, counts = hot.value
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = []
            for doc, s in zip(ids, shingle_sets(batch.column("text").to_pylist(), words)):
                n, mark = len(s), _mark(s)
                if n and doc is not None and mark not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(mark)
                    if len(ranked):
                        i = np.minimum(np.searchsorted(ranked, s), len(ranked) - 1)
                        count = np.where(ranked[i] == s, counts[i], 0)
                        s = s[np.argsort(count, kind="stable")]
                    out.append((doc, n, s[: prefix_length(n, num, den)].view(np.int64)))
            doc, n, keys = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n", "keys"])

    return run


def _overlaps(words: int):
    """Of rows sorted by group, representatives first: the overlap of each
    member with the representatives in each hash range."""

    def run(batches):
        group, heads = None, []
        for batch in batches:
            out = []
            b, part, a, text = (batch.column(c).to_pylist() for c in ("b", "part", "a", "text"))
            for bi, pi, ai, s in zip(b, part, a, shingle_sets(text, words)):
                if (bi, pi) != group:
                    group, heads = (bi, pi), []
                if ai is None:
                    heads.append(s)
                    continue
                for head in heads:
                    size = len(s), len(head)
                    mark = int(s[0]) ^ int(head[-1]) if size[0] and size[1] else 0
                    for f, (x, y) in enumerate(zip(_fragments(s), _fragments(head))):
                        out.append((ai, bi, mark >> 1, *size, f, np.intersect1d(x, y, assume_unique=True).size))
            cols = zip(*out) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "mark", "na", "nb", "fragment", "same"])

    return run


def _fragments(s: np.ndarray) -> list[np.ndarray]:
    cuts = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
    return np.split(s, np.searchsorted(s, cuts))


def near_documents(docs: DataFrame, num: int = 75, den: int = 100, words: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of
    ``docs(doc_id, text)``: documents whose Jaccard similarity is at least
    ``num / den`` are linked, ``component_id`` is the smallest doc_id reachable.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = src.select("text").mapInArrow(_hot(words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES).toArrow()  # bounded; it only ranks the order
    shingle = top.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(shingle)
    hot = spark.sparkContext.broadcast((shingle[order], top.column("n").to_numpy().astype(np.int64)[order]))
    sets = cut(src.mapInArrow(_marks(words), "doc_id long, n long, h1 long, h2 long"))

    marks = sets.where("n > 0 and doc_id is not null").select("doc_id", "n", "h1", "h2")
    firsts = cut(marks.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("b"), F.count("*").alias("c")).where("c > 1").drop("c"))
    same = marks.join(firsts, ["n", "h1", "h2"]).select(F.col("doc_id").alias("a"), "b").where("a <> b")

    # Sets are made anew for their prefixes, which would take half as much disk as the texts do.
    def post(rows: DataFrame) -> DataFrame:
        keys = rows.mapInArrow(_prefixes(words, num, den, hot), "doc_id long, n long, keys array<long>")
        keys = keys.select(F.posexplode("keys").alias("at", "key"), F.col("doc_id").alias("id"), "n")
        return keys.select("key", "id", (F.shiftleft("n", 32) + F.col("at")).alias("mark"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs.select("a", "b"))
        sent = F.broadcast if pairs.count() <= AT_ONCE else (lambda df: df)
        parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / F.lit(PART)).alias("parts"))
        text = maybe_in(src, "doc_id", pairs.select(F.col("a").alias("id")))
        members = text.join(sent(pairs.join(parts, "b")), F.col("doc_id") == F.col("a"))
        members = members.select("b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"), "a", "text")
        text = maybe_in(src, "doc_id", pairs.select(F.col("b").alias("id")))
        heads = text.join(sent(parts), F.col("doc_id") == F.col("b"))
        heads = heads.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("a"), "text")
        rows = heads.unionByName(members).repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
        counted = rows.mapInArrow(_overlaps(words), "a long, b long, mark long, na long, nb long, fragment long, same long")
        summed = counted.groupBy("a", "b", "mark", "na", "nb").agg(F.sum("same").alias("same"))
        linked = F.col("same") * den >= (F.col("na") + F.col("nb") - F.col("same")) * num
        return summed.where(linked).select("a", "b").distinct()

    enough = F.col("shared") >= _meetings(F.shiftright("ma", 32), F.shiftright("mb", 32))
    comp = alone(spark, lambda: components(same.unionByName(
        link(post(src), verify, best=True, near=_may_reach(num, den), enough=enough, sample=post(src.where(in_sample("doc_id")))))))
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, num: int = 75, den: int = 100, words: int = 5) -> DataFrame:
    """One row of ``docs`` of each group of near documents: that with the
    smallest doc_id. Rows that repeat a doc_id are told apart by their texts:
    each different text under such an id is a document of its own, behind all
    others, and of rows that repeat both one stays. Rows without a doc_id all
    stay."""
    src = boxed(docs).withColumn("mark", F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.coalesce("text", F.lit("")))))
    several = src.groupBy("doc_id").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo < hi")
    several = src.join(several.select(F.col("doc_id").alias("of")), F.col("doc_id") == F.col("of"), "left_semi").select("doc_id", "mark").distinct()
    last = src.agg(F.max("doc_id")).first()[0] or 0  # one number
    # new ids are fixed by being written
    several = cut(several.select(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark"), (F.monotonically_increasing_id() + F.lit(last + 1)).alias("new")))
    named = src.join(several, (F.col("doc_id") == F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    named = named.select("row", F.coalesce("new", "doc_id").alias("doc_id"), "text")
    heads = alone(docs.sparkSession, lambda: near_documents(named, num, den, words).where("component_id = doc_id").select("doc_id").distinct())
    order = Window.partitionBy("doc_id").orderBy("text")
    kept = named.join(heads, "doc_id").withColumn("n", F.row_number().over(order)).where("n = 1")
    return unboxed(kept.select("row").unionByName(src.where("doc_id is null").select("row")), docs)
