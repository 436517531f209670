"""Divergence of sources inside a language, by Gustavson's row accumulation.

Every language keeps the terms of at least ``min_docs`` of its documents; a
group (language, source), and the language itself, gives each kept term the
share ``p = 1 + floor(10^9 (count + 1) / (N + V))``. The divergence of p from
q at a term is ``floor((p - q)^2 / q)``, all in integers.

A group's divergences from all peers are one row of a sparse product. The
term-major index (the groups that hold a term, with their shares) is dealt by
term into blocks of bounded size; in a block, each group goes through its
terms and scatters each term's index entries into a dense accumulator, one
cell for each peer. No pair of postings is emitted: a block returns one sum
for each group and peer it meets, and Spark adds the blocks. Since a group
gives a share to the kept terms it lacks as well, every cell starts from a
baseline that takes all terms as held by at most one of the two, from the
groups' counts of equal shares; the scattered values correct it where both
hold a term. Languages with more sources than `TILE` are dealt into tiles of
groups by tiles of peers, so accumulators stay bounded.

Counts are summed in the tasks that read the texts, before any shuffle. A term
is a run of letters a-z (A-Z lower-cased) and characters beyond ASCII.

Cases: null text, lang and source are ''. A group without terms has all its
shares from the baseline; a language without kept terms has values of 0 and no
term rows; a language with one source has no pair rows. Rows count one by one,
repeated doc_ids or texts included.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .words import byte_table, text_rows, word_slices

LETTERS = byte_table(digits=False)
SCALE = 1_000_000_000
TILE = 1024  # groups whose cells one accumulator holds
BLOCK = 1 << 18  # index entries in a block, about
HELD = 1 << 18  # counts that a task holds before it hands them on


def _counts(batches):
    """``lang, source, term, n, docs``: partial counts."""
    held, size = {}, 0

    def flush():
        cols = ([], [], [], [], [])
        for (lang, source), (n, docs) in held.items():
            cols[0].extend([lang] * len(n))
            cols[1].extend([source] * len(n))
            cols[2].extend(n)
            cols[3].extend(n.values())
            cols[4].extend(map(docs.__getitem__, n))
        kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        cols = [pa.array(c, k) for c, k in zip(cols, kinds)]
        return pa.RecordBatch.from_arrays([c.cast(pa.string()) if i < 3 else c for i, c in enumerate(cols)], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, body in text_rows(batch, ["lang", "source", "text"]):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for words in word_slices(body, LETTERS):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(n) - before
            if size >= HELD:
                yield flush()
                held, size = {}, 0
    if size:
        yield flush()


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(10^9 (n + 1) / (total + kept))``, exact for any count."""
    top = (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(kept > 0, F.call_function("div", top, (total + kept).cast("decimal(20,0)")) + 1)


def gap(p, q):
    return (p - q) ** 2 // q


def gap_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _scatter(block: pa.Table) -> pa.Table:
    """Of a block of the index, ``a, b, value``: corrections of the baseline
    for each group of tile ``ti`` and peer of tile ``tj`` that share a term."""
    ti, tj = block.column("ti")[0].as_py(), block.column("tj")[0].as_py()
    gid, tile, p, p0 = (block.column(c).to_numpy() for c in ("gid", "tile", "p", "p0"))
    term = block.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    peers = np.flatnonzero(tile == tj)
    peers = peers[np.argsort(term[peers], kind="stable")]  # term-major
    first = np.searchsorted(term[peers], np.arange(term.max() + 2))
    cells, cell = np.unique(gid[peers], return_inverse=True)
    rows = np.flatnonzero(tile == ti)
    rows = rows[np.argsort(gid[rows], kind="stable")]
    out = [(gid[:0], gid[:0], gid[:0])]
    for row in np.split(rows, np.flatnonzero(np.diff(gid[rows])) + 1):
        if not len(row):
            continue
        n = first[term[row] + 1] - first[term[row]]
        at = np.repeat(first[term[row]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        mine, mine0, at_peer = np.repeat(p[row], n), p0[row[0]], peers[at]
        q, q0 = p[at_peer], p0[at_peer]
        dense, met = np.zeros(len(cells), np.int64), np.zeros(len(cells), bool)
        np.add.at(dense, cell[at], gap(mine, q) - gap(mine, q0) - gap(mine0, q) + gap(mine0, q0))
        met[cell[at]] = True
        met &= cells != gid[row[0]]
        out.append((np.full(met.sum(), gid[row[0]]), cells[met], dense[met]))
    cols = [np.concatenate(c) for c in zip(*out)]
    return pa.table([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "value"])


def _baseline(tiles: pa.Table) -> pa.Table:
    """``a, b, value`` for every group of tile ``ti`` and peer of ``tj``, as if
    they shared no term, from ``gid, tile, p0, kept, p, m``: m terms with share p
    (none: p is null)."""
    ti, tj = tiles.column("ti")[0].as_py(), tiles.column("tj")[0].as_py()
    gid, tile, p0, kept = (tiles.column(c).to_numpy() for c in ("gid", "tile", "p0", "kept"))
    m = tiles.column("m").to_numpy()
    p = tiles.column("p").fill_null(1).to_numpy()

    def side(t):
        at = np.flatnonzero(tile == t)
        at = at[np.argsort(gid[at], kind="stable")]
        ids, first = np.unique(gid[at], return_index=True)
        return at, ids, first, np.add.reduceat(m[at], first) if len(at) else m[:0]

    mine, a, first_a, size_a = side(ti)
    peers, b, first_b, size_b = side(tj)
    q0 = p0[peers[first_b]]
    out = [(m[:0], m[:0], m[:0])]
    for k, (g, at) in enumerate(zip(a, np.split(mine, first_a[1:]))):
        own = p0[at[0]]
        value = (kept[at[0]] - size_a[k] - size_b) * gap(own, q0)
        for x, times in zip(p[at], m[at]):
            if times:
                value = value + times * gap(x, q0)
        value = value + np.add.reduceat(m[peers] * gap(own, p[peers]), first_b)
        other = b != g
        out.append((np.full(other.sum(), g), b[other], value[other]))
    cols = [np.concatenate(c) for c in zip(*out)]
    return pa.table([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "value"])


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the groups of
    ``docs(lang, source, text)``. Part ``pair``: item is each other source of
    the language, value the sum over all kept terms of the group's divergence
    from it. Part ``term``: item is each term with a larger share in the group
    than in the language, value its divergence, the ``top`` largest of a group."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    src = docs.select(text("lang"), text("source"), text("text"))
    counts = cut(src.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
                 .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = cut(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))
    counts = cut(counts.drop("docs").join(terms, ["lang", "term"]))

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = src.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    groups = groups.select("lang", "source", zero("total").alias("total"), zero("held").alias("held"), zero("kept").alias("kept"), zero("lang_total").alias("lang_total"))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(tile)).alias("tiles"), F.sum("held").alias("entries"))
    sizes = sizes.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("entries") / F.lit(block))))
    groups = groups.join(sizes.drop("entries"), "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
    # ids are fixed by being written
    groups = cut(groups.withColumns({"gid": F.monotonically_increasing_id(), "p0": F.coalesce(share(F.lit(0), F.col("total"), F.col("kept")), F.lit(1))}))

    entries = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "gid", "tile", "tiles", "blocks", "term", "p0", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))

    def tiled(df: DataFrame, *also) -> DataFrame:
        """Each row for all tiles of groups and of peers that it takes part in."""
        others = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
        as_row = F.transform(others, lambda t: F.struct(F.col("tile").alias("ti"), t.alias("tj")))
        as_peer = F.transform(F.filter(others, lambda t: t != F.col("tile")), lambda t: F.struct(t.alias("ti"), F.col("tile").alias("tj")))
        return df.select("lang", "gid", "tile", "p0", *also, F.explode(F.concat(as_row, as_peer)).alias("t")).select("*", "t.ti", "t.tj").drop("t")

    index = tiled(entries, "term", "p", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"))
    out = "a long, b long, value long"
    scattered = index.groupBy("lang", "ti", "tj", "block").applyInArrow(_scatter, out)
    alike = entries.groupBy("gid", "p").agg(F.count("*").alias("m"))
    alike = groups.join(alike, "gid", "left").withColumn("m", zero("m"))
    base = tiled(alike, "kept", "p", "m").groupBy("lang", "ti", "tj").applyInArrow(_baseline, out)
    pairs = scattered.unionByName(base).groupBy("a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    name = lambda i, s: groups.select(F.col("gid").alias(i), F.col("lang").alias(f"{i}_lang"), F.col("source").alias(s))
    pairs = pairs.join(name("a", "source"), "a").join(name("b", "item"), "b").select(F.col("a_lang").alias("lang"), "source", "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    larger = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), gap_column(F.col("p"), F.col("q")).alias("value"))
    return ranked(pairs, "pair").unionByName(ranked(larger, "term").where(F.col("rank") <= top))
