import math

import numpy as np
import pytest

from tessera.llm.embed_lsh import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, id long, unit string"


def brute(rows, threshold):
    """Cosines of all pairs, by dimension and label."""
    groups = {}
    for i, v, label in rows:
        if v and label is not None and None not in v and all(map(math.isfinite, v)) and any(v):
            x = np.array(v, np.float64)
            groups.setdefault((label, len(v)), []).append((i, x / np.linalg.norm(x)))
    count, low = dict.fromkeys((i for i, _, _ in rows), 0), {i: i for i, _, _ in rows}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for members in groups.values():
        ids, x = [i for i, _ in members], np.array([x for _, x in members])
        hit = x @ x.T >= threshold
        np.fill_diagonal(hit, False)
        for i, row in zip(ids, hit):
            count[i] = int(row.sum())
            for j in np.flatnonzero(row):
                a, b = find(i), find(ids[j])
                low[max(a, b)] = min(a, b)
    return {i: (count[i], find(i), find(i) == i) for i in low}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out, n = [], 0
    for label in (1, 2):
        for size, noise in ((1, 0), (40, 0.03), (7, 0.045), (700, 0.02), (3, 0.0)):
            base = rng.standard_normal(64)
            base /= np.linalg.norm(base)
            for _ in range(size):
                out.append((n, np.float32(base + noise * rng.standard_normal(64)).tolist(), label))
                n += 1
    out += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [float("nan")] * 64, 1), (n + 3, [None] * 64, 1), (n + 4, out[0][1], None), (n + 5, [], 2),
            (n + 6, [1.0, 0.0], 1), (n + 7, [2.0, 0.0], 1), (n + 8, [float("inf")] + [0.0] * 63, 2)]
    return out


def test_links_and_components_of_all_pairs(spark, rows):
    got = near_duplicates(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA), block=256).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows, 0.93)
    assert len(got) == len(rows)


def test_null_ids_repeats_and_empty_tables(spark):
    v = [1.0] + [0.0] * 63
    got = near_duplicates(spark.createDataFrame([(None, v, 1, 0, ""), (4, v, 1, 0, ""), (4, v, 1, 0, ""), (9, v, 1, 0, "")], SCHEMA)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (-1, 0, None, False), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_under_a_hot_key_of_one_id(spark):
    """A repeated id makes keys hot; the other id's only row counts."""
    v = np.float32(np.random.default_rng(1).standard_normal(64)).tolist()
    rows = [(246, [x * (1 + i / 1000) for x in v], 1, 0, "") for i in range(100)] + [(2, v, 1, 0, "")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component_id"] for r in got} == {2}
