from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from clvspark.llm import suffix_dedup
from clvspark.llm.passages import previous_factors

from .cases import documents, empty


def _expected(rows, width, keep):
    seen, first = Counter(), {}
    rows = sorted((k if k is not None else -1, suffix_dedup._digest((t or "").encode()), i, (t or "").encode()) for i, (k, t) in enumerate(rows))
    for k, d, _, b in rows:
        for s in range(len(b) - width + 1):
            seen[b[s:s + width]] += 1
            first.setdefault(b[s:s + width], (k, d, s))
    out = Counter()
    for k, d, _, b in rows:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            x = b[s:s + width]
            if seen[x] > 1 and (keep == "none" or first[x] != (k, d, s)):
                gone[s:s + width] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[k, len(b), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()] += 1
    return out


@pytest.mark.parametrize("keep,hot", [("none", 2000), ("first", 2000), ("none", 3), ("first", 3)])
def test_against_brute_force(spark, keep, hot):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    shared = [text(n) for n in (35, 60, 90)]
    rows = [(i, "".join(r.choice(shared)[r.randint(0, 6):] if r.random() < 0.5 else text(r.randint(1, 60))
                        for _ in range(r.randint(0, 7)))) for i in range(150)]
    rows += [(300, "a" * 200), (301, "ab" * 90), (302, None), (303, ""), (304, "a" * 29), (305, rows[3][1]), (3, rows[3][1]), (4, text(80) + shared[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((x.doc_id, x.n_bytes, len(x.spans), bytes(x.kept)) for x in
                  suffix_dedup.remove_repeats(df, width=30, gram=8, keep=keep, hot=hot).collect())
    assert got == _expected(rows, 30, keep)


def test_edges(spark):
    rows = {(x.doc_id, x.n_bytes, len(x.kept)) for x in suffix_dedup.remove_repeats(documents(spark), keep="none").collect()}
    assert (2, 0, 0) in rows and (8, 3000, 0) in rows and any(i == 6 and k < 200 for i, _, k in rows) and any(i is None for i, _, _ in rows)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_longest_previous_factors():
    earlier, other = previous_factors([b"abcabcx", b"zabcab"], 4)
    assert [e.tolist() for e in earlier] == [[False] * 4, [False, True, True]]
    assert [o.tolist() for o in other] == [[True, True, False, False], [False, True, True]]
