from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clvspark.llm import pivot_index


def _expected(rows):
    units = [pivot_index.unit(v) for _, v in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and rows[i][0] is not None and rows[j][0] is not None and units[i] is not None
             and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95] for i in range(n)]
    label = [r[0] for r in rows]
    while True:
        new = [min([label[i], *(label[j] for j in near[i])]) if label[i] is not None else None for i in range(n)]
        if new == label:
            return sorted(((rows[i][0], len(near[i]), label[i], rows[i][0] == label[i]) for i in range(n)), key=str)
        label = new


def test_links_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows, k = [], 0
    for _ in range(150):  # pairs just above the threshold
        v = rng.normal(size=32)
        v /= np.linalg.norm(v)
        w = rng.normal(size=32)
        w -= w @ v * v
        w /= np.linalg.norm(w)
        c = 0.9505
        rows += [(k, v.tolist()), (k + 1, (c * v + np.sqrt(1 - c * c) * w).tolist())]
        k += 2
    v = rng.normal(size=32)  # one large group
    rows += [(k + i, (v + rng.normal(size=32) * 0.15).tolist()) for i in range(200)]
    k += 200
    rows += [(k, rows[-1][1]), (k + 1, [0.0] * 32), (k + 2, None), (k + 3, [float("nan")] * 32), (k + 4, [1.0, 2.0]),
             (k + 5, [2.0, 4.0]), (k + 6, []), (None, rows[-1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("key", "unit", "digest", "copies", "order")})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivot_index.near_vectors(df, cell=60).collect()), key=str)
    want = [(i, n, c, True if i is None else k) for i, n, c, k in _expected(rows)]
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.99 * there <= found <= there  # an index: what it finds is verified, some links may be missed
    assert {r[2] for r in got if r[0] is not None and 300 <= r[0] <= 500} == {300}
    assert [r for r in got if r[0] is None or r[0] > 500] == [r for r in want if r[0] is None or r[0] > 500]


def test_empty_table(spark):
    assert pivot_index.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lengths_without_a_pivot(spark):
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(2000, 16)))]
    for size in range(3, 12):  # two different near vectors and one far off of each length
        v = rng.normal(size=size)
        rows += [(10_000 + 10 * size + k, w) for k, w in enumerate((v.tolist(), (v * 1.0 + 1e-3).tolist(), (-v).tolist()))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivot_index.near_vectors(df).collect()}
    for size in range(3, 12):
        k = 10_000 + 10 * size
        assert [got[k], got[k + 1], got[k + 2]] == [(1, k, True), (1, k, False), (0, k + 2, True)], size
