from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa

from clvspark.llm import stratum_index as si

from .cases import documents, empty

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def _best(docs, items, k=20):
    """The contract over all rows: sorted (item, rank, doc, score)."""
    counted = [(i, Counter(_terms(t))) for i, t in docs if _terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        asked, found = Counter(_terms(text)), []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(q * w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def _got(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, si.search(si.build(d), q, **options).collect()), key=str)


def test_against_all_rows(spark, monkeypatch):
    monkeypatch.setattr(si, "_BLOCK_DOCS", 7)   # many blocks in a stratum
    monkeypatch.setattr(si, "_CHUNK", 3)        # many chunks of items
    r = random.Random(2)
    words = [f"w{i}" for i in range(40)] + ["Éa", "éa", "ß", "x_y", "A-b"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = [(i, text(int(r.paretovariate(0.9)) + 1)) for i in range(300)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]                # copies: ties
    docs += [(2000, None), (2001, "... !"), (5, text(9)), (None, docs[3][1]), (2002, "w1 " * 30_000)]
    items = [(i, text(r.randint(1, 30))) for i in range(12)] + [(50, None), (51, "nowhere"), (52, "w1 w1 w1"), (0, docs[3][1])]
    want = _best(docs, items)
    for first in (1, 8):
        assert _got(spark, docs, items, first=first) == want


def test_strata_below_the_bound_are_not_visited(spark, monkeypatch):
    docs = [(i, "rare words here") for i in range(30)] + [(100 + i, "filler " * (50 + 40 * i) + "here") for i in range(30)]
    seen = []
    visit = si._visit
    monkeypatch.setattr(si, "_visit", lambda postings, terms, visits, k: (seen.append(visits.count()), visit(postings, terms, visits, k))[1])
    items = [(1, "rare words here")]
    assert _got(spark, docs, items, first=1) == _best(docs, items)
    assert seen == [1, 0]


def test_edges(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(1, "same text twice over here"), (2, ""), (3, "the text 日本語のテキスト")]
    q = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, si.search(si.build(docs), q).collect()), key=str) == _best(rows, items)
    assert si.search(si.build(empty(spark)), q).count() == 0
    assert si.search(si.build(docs), q.limit(0)).count() == 0


def test_postings_leave_in_bounded_batches(monkeypatch):
    class Taken:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    monkeypatch.setattr(si, "_OUT_ROWS", 4, raising=False)
    docs = {(75, 0): [(3, {"a": 1, "b": 2, "c": 1}), (8, {"a": 1, "b": 1, "d": 5}), (None, {"b": 2})], (80, 1): [(4, {"a": 9})]}
    rows = [(*at, i, " ".join(c), list(c.values())) for at, held in docs.items() for i, c in held]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32())]
    batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                       names=["m", "block", "key", "words", "tfs"])
    sent = list(si._blocks(Taken())(iter([batch.slice(0, 2), batch.slice(2)])))
    assert [b.num_rows for b in sent] == [4, 2, 2]
    got = [tuple(r.values()) for b in sent for r in b.to_pylist()]
    want = []
    for at, held in docs.items():
        want.append((*at, "", 0, [], [i for i, _ in held]))
        postings = {(t, tf) for _, c in held for t, tf in c.items()}
        want += [(*at, t, tf, [place for place, (_, c) in enumerate(held) if c.get(t) == tf], []) for t, tf in postings]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [r[2] for r in got if r[2] == ""] == ["", ""] and got[0][2] == ""
