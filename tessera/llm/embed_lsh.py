"""Near-duplicate embeddings by p-stable (Gaussian) hashing.

Each table hashes a normalised vector to ``hashes`` quantised Gaussian
projections ``floor((a.v + b) / width)``. For unit vectors the distance is
``sqrt(2 - 2 cos)``, so near vectors fall into one bucket of some table.
Within a label, vectors that share a bucket are candidates; a 64-bit sign
sketch drops the hopeless ones (six standard deviations below the threshold)
and an exact cosine in double precision decides.

The links found by `common.link` fix the components. Links per vector are
then counted inside components, in square blocks of at most ``block`` vectors
a side: only counts leave a task, never the pairs.

Cases: vectors that are null, zero, or hold null or non-finite components and
rows with a null label link with nothing. Vectors of different lengths never
link. Rows that repeat a vec_id are compared each, share a component, since
ids name components, and report the most links that one of them has. Rows with a null vec_id come
back with no links and a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, link

BLOCK = 512


def _rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Index and float64 vector of each usable row."""
    for i, v in enumerate(column.to_pylist()):
        if v and None not in v:
            x = np.array(v, dtype=np.float64)
            scale = np.abs(x).max()
            if np.isfinite(scale) and scale > 0:
                x = x / scale  # no over- or underflow in the norm
                yield i, x / math.sqrt(float(x @ x))


def _hasher(tables: int, hashes: int, width: float, seed: int):
    made: dict[int, tuple] = {}

    def planes(dim: int):
        if dim not in made:
            rng = np.random.default_rng([seed, dim])
            a = rng.standard_normal((dim, tables * hashes))
            b = rng.uniform(0, width, tables * hashes)
            mix = rng.integers(1, 1 << 62, (tables, hashes), dtype=np.int64).view(np.uint64) | np.uint64(1)
            made[dim] = a, b, mix, rng.standard_normal((dim, 64))
        return made[dim]

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"vec_id": [], "label": [], "unit": [], "sketch": [], "keys": []}
            ids, labels = batch.column("vec_id"), batch.column("label")
            for i, x in _rows(batch.column("embedding")):
                a, b, mix, signs = planes(len(x))
                q = np.floor((x @ a + b) / width).astype(np.int64).view(np.uint64).reshape(tables, hashes)
                with np.errstate(over="ignore"):
                    h = (q * mix).sum(axis=1, dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(31)
                    h *= np.uint64(0xBF58476D1CE4E5B9)
                out["vec_id"].append(ids[i].as_py())
                out["label"].append(labels[i].as_py())
                out["unit"].append(x.tobytes())
                out["sketch"].append(int(np.packbits(x @ signs > 0).view(np.int64)[0]))
                out["keys"].append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["vec_id"], pa.int64()), pa.array(out["label"], pa.int64()), pa.array(out["unit"], pa.binary()),
                 pa.array(out["sketch"], pa.int64()), pa.array(out["keys"], pa.list_(pa.int64()))], names=list(out))

    return run


def _cosines(batches):
    """Exact cosine of the unit vectors ``u`` and ``v``."""
    for batch in batches:
        u, v = batch.column("u").to_pylist(), batch.column("v").to_pylist()
        cos = [_cos(np.frombuffer(x), np.frombuffer(y)) for x, y in zip(u, v)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(cos, pa.float64())], names=["a", "b", "cos"])


def _cos(x: np.ndarray, y: np.ndarray) -> float:
    return float(x @ y) if len(x) == len(y) else -2.0


def _count_block(threshold: float):
    def run(key, pdf):
        import pandas as pd

        left, right = pdf[pdf.side != 1], pdf[pdf.side != 0]
        same = key[2] == key[3]
        counts: dict[int, int] = {}
        width = {len(u) for u in pdf.unit}
        for w in width:
            x, y = left[left.unit.str.len() == w], right[right.unit.str.len() == w]
            if not len(x) or not len(y):
                continue
            xs = np.frombuffer(b"".join(x.unit)).reshape(len(x), -1)
            ys = np.frombuffer(b"".join(y.unit)).reshape(len(y), -1)
            hit = xs @ ys.T >= threshold
            if same:
                np.fill_diagonal(hit, False)
            for row, n in zip(x.row, hit.sum(axis=1)):
                counts[row] = counts.get(row, 0) + int(n)
            if not same:
                for row, n in zip(y.row, hit.sum(axis=0)):
                    counts[row] = counts.get(row, 0) + int(n)
        return pd.DataFrame({"row": list(counts), "n": list(counts.values())}, columns=["row", "n"]).astype("int64")

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tables: int = 80, hashes: int = 8,
                    width: float = 1.0, seed: int = 11, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of
    ``vectors(vec_id, embedding, label)``.

    With the default tables a pair at cosine 0.93 shares a bucket of some
    table with probability 0.992, one at 0.95 with 0.9997.
    """
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    usable = src.where("vec_id is not null and label is not null and embedding is not null")
    vecs = cut(usable.mapInArrow(_hasher(tables, hashes, width, seed),
                                 "vec_id long, label long, unit binary, sketch long, keys array<long>"))
    post = vecs.select(F.explode("keys").alias("k"), "label", F.col("vec_id").alias("id"), F.col("sketch").alias("mark"))
    post = post.select(F.xxhash64("k", "label").alias("key"), "id", "mark")

    angle = math.acos(min(1.0, threshold)) / math.pi
    most = math.ceil(64 * angle + 6 * math.sqrt(64 * angle * (1 - angle)))

    def verify(pairs: DataFrame) -> DataFrame:
        p = pairs.join(vecs.select(F.col("vec_id").alias("a"), F.col("label").alias("la"), F.col("unit").alias("u")), "a")
        p = p.join(vecs.select(F.col("vec_id").alias("b"), F.col("label").alias("la"), F.col("unit").alias("v")), ["b", "la"])
        p = p.select("a", "b", "u", "v").mapInArrow(_cosines, "a long, b long, cos double")
        return p.where(F.col("cos") >= threshold).select("a", "b").distinct()

    comp = cut(components(link(post, verify, near=lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= most)))

    # links per vector: blocks of a component and label against each other
    rows = vecs.select("vec_id", "label", "unit", F.monotonically_increasing_id().alias("row"))
    rows = cut(rows.join(comp.withColumnRenamed("id", "vec_id"), "vec_id"))
    named = rows.select("vec_id", "row")
    sizes = rows.groupBy("component", "label").agg(F.ceil(F.count("*") / F.lit(block)).alias("parts"))
    rows = rows.join(sizes, ["component", "label"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    rows = rows.select("component", "label", "row", "unit", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    rows = rows.select("label", "component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "row", "unit",
                       F.when(F.col("part") == F.col("other"), -1).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"))
    counts = rows.groupBy("component", "label", "i", "j").applyInPandas(_count_block(threshold), "row long, n long")
    counts = counts.groupBy("row").agg(F.sum("n").alias("n"))
    ids = named.join(counts, "row").groupBy("vec_id").agg(F.max("n").alias("n"))
    out = src.select("vec_id").join(ids, "vec_id", "left").join(comp.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    comp_id = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))
