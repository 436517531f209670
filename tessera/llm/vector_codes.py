"""Vector code compression: product codes by equal-average nearest-entry search.

A component x becomes the integer floor(256 x); a vector is cut into ``parts``
equal consecutive parts, each part position has a codebook of ``entries``
entries, started from the vectors with the smallest vec_ids and moved in
``rounds`` rounds to the floor of the mean of the parts assigned to it.

The nearest entry of a part is found by its component sum: entries are sorted
by theirs, and the search goes outward from the part's own sum, the nearer side
first. The squared gap of two sums over the dimension is never more than the
squared distance, so it ends where that strictly exceeds the best distance
(entries at an equal one may still tie with a lower index). All parts of a
batch go outward together, as arrays; those that are done leave.

A round's sums are added up in each task first; what comes to the driver is
one number for each codebook component (of 40-bit limbs, so that they are exact
at any size), and the codebooks are all that is broadcast.

Cases: rows whose vector is null or holds null, NaN or infinite components are
left out, as are those of another length than the kept row with the smallest
vec_id. A length that the parts do not divide is filled up with zeros. A null
vec_id sorts after all others; rows that repeat a vec_id are kept each and
sort by components. With fewer rows than ``entries`` the codebooks are smaller.
Components too large for 64-bit sums are computed as unbounded integers; an
error beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

LIMB = 40


def integers(flat: np.ndarray, rows: int, width: int) -> np.ndarray:
    """floor(256 x) as a (rows, width) table, in 64 bits where squares and sums fit."""
    x = flat.reshape(rows, width)
    if np.abs(x).max(initial=0) < 2 ** 18 / max(1, width):
        return np.floor(x * 256).astype(np.int64)
    whole = lambda v: int(v) * 256 if abs(v) >= 2 ** 53 else int(np.floor(v * 256))
    return np.array([whole(float(v)) for v in x.ravel()], object).reshape(rows, width)


def cut_parts(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width of a part)."""
    width = -(-x.shape[1] // parts)
    filled = np.zeros((len(x), parts * width), x.dtype)
    filled[:, :x.shape[1]] = x
    return filled.reshape(len(x), parts, width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to each row's nearest entry of ``book``;
    of equal distances the lowest index."""
    if book.dtype == object or x.dtype == object:
        x, book = x.astype(object), book.astype(object)
    sums = book.sum(axis=1) if book.shape[1] else np.zeros(len(book), np.int64)
    order = np.argsort(sums, kind="stable")
    sums, book = sums[order], book[order]
    own = x.sum(axis=1) if x.shape[1] else np.zeros(len(x), np.int64)
    right = np.searchsorted(sums, own)
    left = right - 1
    width, last = x.shape[1], len(book) - 1
    best, found = np.zeros(len(x), x.dtype), np.full(len(x), len(book))
    live = np.arange(len(x))
    while len(live):
        at_left, at_right, mean = left[live], right[live], own[live]
        down, up = mean - sums[np.maximum(at_left, 0)], sums[np.minimum(at_right, last)] - mean
        go_left = (at_left >= 0) & ((at_right > last) | (down <= up).astype(bool))
        gap = np.where(go_left, down, up)
        none_yet = found[live] > last
        more = ((at_left >= 0) | (at_right <= last)) & (none_yet | (gap * gap <= best[live] * width).astype(bool))
        live, go_left, at_left, at_right, none_yet = (v[more] for v in (live, go_left, at_left, at_right, none_yet))
        entry = np.where(go_left, at_left, at_right)
        away = x[live] - book[entry]
        distance = (away * away).sum(axis=1) if width else np.zeros(len(live), x.dtype)
        index = order[entry]
        better = none_yet | (distance < best[live]).astype(bool) | ((distance == best[live]).astype(bool) & (index < found[live]))
        best[live[better]], found[live[better]] = distance[better], index[better]
        left[live[go_left]] -= 1
        right[live[~go_left]] += 1
    return found, best


def limbs(value: int) -> list[int]:
    """``value`` as the sum of limb k times 2^(40 k)."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _tables(batch: pa.RecordBatch, width: int, parts: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy()
    return cut_parts(integers(flat, batch.num_rows, width), parts)


def _sums(books, width: int):
    """``part, entry, place, limb, value``: sums and (place -1) counts of the
    parts assigned to each entry."""

    def run(batches):
        book = books.value
        total = np.zeros(book.shape[:2] + (book.shape[2] + 1,), object)
        for batch in batches:
            x = _tables(batch, width, len(book))
            for part, entries in enumerate(book):
                code, _ = nearest(x[:, part], entries)
                some = np.zeros(total.shape[1:], x.dtype)
                np.add.at(some[:, 1:], code, x[:, part])
                some[:, 0] = np.bincount(code, minlength=len(entries))
                total[part] += some.astype(object)
        rows = [(p, e, k - 1, i, v) for p, e, k in np.argwhere(total != 0).tolist() for i, v in enumerate(limbs(total[p, e, k]))]
        cols = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["part", "entry", "place", "limb", "value"])

    return run


def _moved(src: DataFrame, book: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after a round."""
    books = src.sparkSession.sparkContext.broadcast(book)
    sums = src.select("vector").mapInArrow(_sums(books, width), "part long, entry long, place long, limb long, value long")
    total = np.zeros(book.shape[:2] + (book.shape[2] + 1,), object)
    for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():  # bounded by the codebooks
        total[r["part"], r["entry"], r["place"] + 1] += r["value"] << (LIMB * r["limb"])
    out = book.astype(object)
    for part, entry in np.argwhere(total[:, :, 0] > 0):
        out[part, entry] = total[part, entry, 1:] // total[part, entry, 0]
    return _packed(out)


def _packed(book: np.ndarray) -> np.ndarray:
    """As 64-bit integers where these are small enough, with all parts' width to spare."""
    most = max((abs(v) for v in book.ravel()), default=0)
    return book.astype(np.int64) if most < 2 ** 26 // max(1, book.shape[0] * book.shape[2]) else book


def train(src: DataFrame, parts: int, entries: int, rounds: int) -> tuple[np.ndarray, int] | None:
    """Codebooks (part, entry, place) of ``src(vec_id, vector)`` and the
    vectors' length; nothing for no rows."""
    by_id = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = src.select("vec_id", "vector").orderBy(*by_id).limit(1).collect()
    if not first:
        return None
    width = len(first[0]["vector"])
    src = src.where(F.size("vector") == width)
    seeds = [r["vector"] for r in src.select("vec_id", "vector").orderBy(*by_id).limit(entries).collect()]
    x = cut_parts(integers(np.array(seeds, np.float64).ravel(), len(seeds), width), parts)
    book = _packed(np.ascontiguousarray(x.transpose(1, 0, 2)).astype(object))
    for _ in range(rounds):
        book = _moved(src, book, width)
    return book, width


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the rows of
    ``vectors(vec_id, embedding, label)`` that can be coded."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits for each part")
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").alias("label"))
    src = src.where(F.col("vector").isNotNull()).where(~bad)
    got = train(src, parts, entries, rounds)
    book, width = got or (np.zeros((parts, 0, 0), np.int64), 0)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    books = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        book = books.value
        for batch in batches:
            x = _tables(batch, width, len(book))
            codes = np.zeros((batch.num_rows, len(book)), np.uint8)
            error = np.zeros(batch.num_rows, object)
            for part, entry in enumerate(book):
                found, distance = nearest(x[:, part], entry)
                codes[:, part] = found
                error += distance.astype(object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array([e if e < 1 << 63 else None for e in error], pa.int64()), batch.column("label")], names=["vec_id", "code", "error", "label"])

    kinds = src.select("vec_id").schema.add("code", "string").add("error", "long").add(src.schema["label"])
    coded = cut(src.where(F.size("vector") == width).mapInArrow(run, kinds))
    exact = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(20,0)")))
    sums = coded.groupBy(F.col("label").alias("of")).agg(exact.alias("total")).select("of", F.col("total").try_cast("long").alias("label_error"))
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
