"""Document fingerprints by winnowing.

Code points are hashed in overlapping ``k``-grams by a rolling polynomial; in
every window of ``window`` consecutive hashes the smallest is chosen, the
rightmost on ties, and kept with its position. Two texts that share a run of
``k + window - 1`` code points share a fingerprint from it.

A text shorter than ``k`` has one gram, itself; one with fewer grams than a
window has one window. An empty or null text has no gram: its fingerprint is
empty, and its likeness is 1 to another empty one and 0 to any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K, WINDOW = 16, 16
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams; a window's sum doubles from powers of two."""
    n = len(points)
    if not n:
        return np.empty(0, np.uint64)
    k = min(k, n)
    block, done, size = points.astype(np.uint64) + np.uint64(1), None, 1
    width = 0
    with np.errstate(over="ignore"):
        while True:
            if k & size:  # append this block to what is hashed already
                if done is None:
                    done, width = block, size
                else:
                    m = len(done) - size
                    done = done[:m] * np.uint64(pow(BASE, size, 1 << 64)) + block[width:width + m]
                    width += size
            if width == k:
                return _mix(done)
            m = len(block) - size
            block = block[:m] * np.uint64(pow(BASE, size, 1 << 64)) + block[size:]
            size *= 2


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes chosen, by position."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    h = gram_hashes(points, k)
    if not len(h):
        return np.empty(0, np.int64), h
    w = min(window, len(h))
    # smallest hash in each window, by doubling; reversed, so that the rightmost position wins ties
    rev = h[::-1]
    low, pos, size = rev, np.arange(len(rev)), 1
    while size * 2 <= w:
        low, pos = _lower(low[:-size], pos[:-size], low[size:], pos[size:])
        size *= 2
    if size < w:
        low, pos = _lower(low[:len(low) - (w - size)], pos[:len(pos) - (w - size)], low[w - size:], pos[w - size:])
    at = np.unique(len(h) - 1 - pos)
    return at, h[at]


def _lower(a, pa_, b, pb):
    first = a <= b
    return np.where(first, a, b), np.where(first, pa_, pb)


def digest(at: np.ndarray, h: np.ndarray) -> str:
    """Positions and hashes as one short string: count, then their SHA-256."""
    body = at.astype("<i8").tobytes() + h.astype("<u8").tobytes()
    return f"{len(at)}:{hashlib.sha256(body).hexdigest()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes, each sorted and distinct."""
    if not len(a) and not len(b):
        return 1.0
    same = np.intersect1d(a, b, assume_unique=True).size
    return same / (len(a) + len(b) - same)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, positions, hashes`` for each row of ``docs(doc_id, text)``."""

    def run(batches):
        for batch in batches:
            got = [winnow(t, k, window) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([p for p, _ in got], pa.list_(pa.int64())),
                 pa.array([h.view(np.int64) for _, h in got], pa.list_(pa.int64()))], names=["doc_id", "positions", "hashes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, positions array<long>, hashes array<long>")


def _compare(k: int, window: int):
    """Over rows by bucket and order: each row against the row behind it.

    One row is held back; the rows marked ``halo`` only close their bucket.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            for bucket, halo, doc, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "halo", "doc_id", "text"))):
                text = text or ""
                at, h = winnow(text, k, window)
                row = bucket, halo, doc, text, digest(at, h), np.unique(h)
                if held is not None and held[0] == bucket and not held[1]:
                    out.append(pair(held, row))
                    held = row
                elif held is None or held[0] != bucket:
                    held = row
                # else: a further halo row of a bucket that is closed
            if out:
                yield batch_of(out)

    def pair(row, after):
        _, _, doc, text, mark, marks = row
        half = len(text) // 2
        edited = text[: len(text) - half] + after[3][:half]
        at, h = winnow(edited, k, window)
        return (doc, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), mark, digest(at, h),
                likeness(marks, np.unique(h)), likeness(marks, after[5]))

    def batch_of(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=NAMES)

    return run


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edit_trial(docs: DataFrame, k: int = K, window: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """Fingerprint of each text and of its edited text, whose last half comes
    from the next document, with their likeness and the next document's.

    Documents are cut at quantiles of doc_id into ``buckets`` ranges, sorted
    inside each and read once; the first document of a range is also sent,
    as a halo row, to close the range before, and the first of all closes
    the last. So neighbours meet without joining the texts.

    Rows with a null doc_id come before all others; rows that repeat a doc_id
    follow each other by text. A single row is its own next.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = [i / n for i in range(1, n)]
    cuts = sorted(set(src.agg(F.percentile_approx("doc_id", grid, 10 * n).alias("q")).first()["q"] or []))
    # ranges in use, each with its smallest id: at most `buckets` rows
    place = _bucket(spark, cuts) if cuts else F.expr("cast(0 as int)")
    placed = src.withColumn("bucket", place)
    first = [(r["bucket"], r["low"]) for r in placed.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("set"), F.col("doc_id").alias("id")))["id"].alias("low")).orderBy("bucket").collect()]
    if not first:
        first = [(0, None)]
    before = [(b, first[i - 1][0], low) for i, (b, low) in enumerate(first)]  # the first closes the last
    closes = spark.createDataFrame(before, "bucket int, to int, low long")
    halo = placed.join(F.broadcast(closes), "bucket").where(F.col("doc_id").eqNullSafe(F.col("low")))
    halo = halo.select(F.col("to").alias("bucket"), F.lit(True).alias("halo"), "doc_id", "text")
    rows = placed.select("bucket", F.lit(False).alias("halo"), "doc_id", "text").unionByName(halo)
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "halo", F.col("doc_id").asc_nulls_first(), "text")
    return rows.mapInArrow(_compare(k, window), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double")


def _bucket(spark: SparkSession, cuts: list[int]):
    """Number of cuts at or below doc_id; 0 for a null one."""
    held = spark.sparkContext.broadcast(np.array(cuts, np.int64))

    def place(ids: pa.Array) -> pa.Array:
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(held.value, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")), pa.int32())

    return F.arrow_udf(place, "int")("doc_id")
