import hashlib
import math

import numpy as np
import pytest

from tessera.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector string, error long"


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes by comparing every part with every entry, in unbounded integers."""
    ok = [(i, [math.floor(256 * float(np.float32(x))) if abs(x) < 2**40 else 256 * int(np.float32(x)) for x in v], lab) for i, v, lab in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not ok:
        return []
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    width = len(min(ok, key=key)[1])
    ok = [r for r in ok if len(r[1]) == width]
    w = -(-width // parts)
    split = lambda v: [(v + [0] * (w * parts - width))[p * w:(p + 1) * w] for p in range(parts)]
    vecs = [split(v) for _, v, _ in ok]
    books = [[split(v)[p] for _, v, _ in sorted(ok, key=key)[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p])) for p, x in enumerate(v)] for v in vecs]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p] for v, g in zip(vecs, got) if g[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    error = [sum(d for d, _ in g) for g in got]
    by = {}
    for (_, _, lab), e in zip(ok, error):
        by[lab] = by.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    fit = lambda e: e if e < 2**63 else None
    return [(i, "".join(f"{k:02x}" for _, k in g), fit(e), fit(by[lab]), sha) for (i, _, lab), g, e in zip(ok, got, error)]


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df, **how).collect()), key=str)


def vectors(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in np.float32(rng.standard_normal(dim) * scale)], int(rng.integers(3)) if i % 5 else None) for i in rng.permutation(n)]


def test_codes_of_brute_force(spark):
    rows = vectors(300, 64, 1, 0.2)
    rows += [(900, rows[0][1], 7), (900, rows[1][1], 7), (901, None, 1), (902, [None] * 64, 1), (903, [float("nan")] + [0.0] * 63, 1),
             (904, [float("-inf")] * 64, 1), (905, [1.0] * 32, 1), (906, [], 1), (None, [0.5] * 64, 2)]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(np.random.default_rng(2).integers(-2, 3, (200, 16)) / 256)]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    rows = [(i, [float(i % 3) / 256] * 32, 1) for i in range(100)]  # equal entries
    assert run(spark, rows, entries=8) == sorted(brute(rows, entries=8), key=str)


@pytest.mark.parametrize("dim", [0, 5, 20])
def test_lengths_that_parts_do_not_divide(spark, dim):
    rows = vectors(40, dim, 3)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_huge_components_are_exact(spark):
    rows = [(i, [x * 10.0 ** (3 * (i % 4)) for x in v], lab) for i, v, lab in vectors(60, 16, 4)] + [(100, [3e38, -3e38] * 8, 1), (101, [1e30] * 16, 1)]
    assert run(spark, rows, entries=6) == sorted(brute(rows, entries=6), key=str)


def test_few_rows_and_empty_tables(spark):
    rows = vectors(5, 64, 6)
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == []


def test_search_ends_only_beyond_the_bound():
    """Against all distances, with many equal sums and distances."""
    rng = np.random.default_rng(7)
    for width in (1, 2, 4, 7):
        for _ in range(20):
            x, book = rng.integers(-3, 4, (100, width)), rng.integers(-3, 4, (rng.integers(1, 40), width))
            d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            found, best = vector_codes.nearest(x, book)
            assert (found == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
            found, best = vector_codes.nearest(x.astype(object), book)
            assert (found == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_limbs():
    for v in (0, -1, 2**40, -(2**40), 10**45 + 3, -(10**45)):
        assert sum(x << (40 * k) for k, x in enumerate(vector_codes.limbs(v))) == v
        assert all(-(1 << 40) <= x <= 1 << 40 for x in vector_codes.limbs(v))
