from __future__ import annotations

import random

from clvspark.llm import minhash
from clvspark.llm.components import components

from .cases import documents, empty


def _expected(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in sets[i] for q in sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i), find(i) == i) for i in ids for s in sets[i])


def test_against_brute_force(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [r.choice(words) for _ in range(120)]
    rows = []
    for i in range(160):  # copies around the threshold, so that stars alone do not settle the buckets
        t = list(base)
        for _ in range(r.randint(0, 6)):
            t[r.randrange(120)] = r.choice(words)
        rows.append((i, " ".join(t)))
    rows += [(500 + i, " ".join(base[:50] + [r.choice(words) for _ in range(50)])) for i in range(40)]
    rows += [(900, None), (901, ""), (902, "Solo"), (903, "solo"), (904, "a b"), (5, rows[60][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, words=3, percent=85, cell=50)
    assert sorted(map(tuple, got.collect())) == _expected(rows, 3, 85)


def test_edges(spark):
    rows = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark)).collect()}
    assert {(9, 9, True), (10, 9, False), (2, 2, True), (3, 3, True), (None, None, True)} <= rows
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_banding_misses_little():
    for percent in (80, 85, 95):
        bands, rows = minhash.banding(percent / 100)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-5 and bands * rows <= 160


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
