from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256

from clvspark.llm import personal_data as pd
from clvspark.llm import queries
from clvspark.llm.frames import table

from .cases import documents, empty

# the stated patterns
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def _fits(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 14 <= len(d) <= 19 and _luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()


def _base(text):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if _fits(k, m[0]))
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in found)


def _written(spans, kinds=4):
    return ",".join(f"{pd.KINDS[s.kind]}:{s.start}:{s.end}" for s in spans if s.kind < kinds)


def test_base_spans_on_hard_texts(spark):
    texts = ["a@b.c_d@e.f x", "\U0001F600 mail a.b@c-d.com, 1.2.3.4.5.6.7.8 256.1.1.1 007.001.0.255", "4111 1111 1111 1111, 4111-1111-1111-1112",
             "+1 (986) 555-4218 +44 20 +1+2+1 234 567 8901", "12345678901234567890 9.9.9.9999 a@b a@b.c.", "1 " * 400, "x" * 800 + "@y.z",
             "1.1.1.1 " * 600, "a@b.c" * 300, "é+49 30 123456 78 é1.2.3.4", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: _written(r.spans) for r in pd.spans(df).collect()}
    assert got == {i: _base(t) for i, t in enumerate(texts)}


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = dict(table(spark, d, "documents").select("doc_id", "text").collect())
    rows = queries.op6_personal_data(spark, d).collect()
    assert len(rows) == len(texts)
    assert all(r.base_sha256 == sha256(_base(texts[r.doc_id]).encode()).hexdigest() for r in rows)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"please write to contact: u{i}@mail.com soon") for i in range(8)]
    rows += [(20, "his contact: QX-5512-K9 was filed"), (21, "again QX-5512-K9 in the files"), (22, "the year 1998x77 of the report was mild")]
    masked = dict(pd.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert masked[20] == "his contact: [ID] was filed" and masked[21] == "again [ID] in the files"
    assert masked[22] == rows[-1][1] and masked[0] == "please write to contact: [EMAIL] soon"


def test_edges(spark):
    docs = documents(spark)
    assert pd.spans(docs).count() == docs.count() and pd.spans(empty(spark)).count() == 0
    masked = pd.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()


# the whole graph in plain Python: same patterns, instances, rounds and limits
_TOKEN = re.compile(r"(?<![A-Za-z0-9_@.+/-])[A-Za-z0-9_+/-]++(?:[.@][A-Za-z0-9_+/-]++)*+")
_CONTEXT = r"[^\W\d]++\s*+[:=#]*+\s*+[\"'(<\[]?"


def _graph_spans(texts, rounds=3, confidence=0.5, min_seeds=3, prior=2.0):
    clean = lambda m: re.sub(r"\s+", "", m).lower()
    totals, edges, seeds, places = Counter(), Counter(), set(), []
    for i, text in enumerate(texts):
        totals.update(clean(m) for m in re.findall(_CONTEXT, text))
        base = [(m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if _fits(k, m[0])]
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text) if m.end() - m.start() >= 6 and re.search("[0-9]", m[0])
                  and not any(a < m.end() and m.start() < e for a, e in base)]
        for (a, e), own in [*((s, True) for s in base), *((t, False) for t in tokens)]:
            before = re.search(_CONTEXT + r"\Z", text[:a])
            word, value = clean(before[0]) if before else "", text[a:e]
            if own or re.fullmatch(r"(?=(?:[^0-9]*[0-9]){6})(?=(?:[^A-Za-z]*[A-Za-z]){3})[A-Za-z0-9_-]{16,}", value):
                seeds.add((word, value))
            if word:
                edges[word, value] += 1
            if not own:
                places.append((i, a, e, word, value))
    seeded = Counter(w for w, v in edges if (w, v) in seeds)
    edges = {(w, v): n for (w, v), n in edges.items() if seeded[w] >= min_seeds}
    score = {k: float(k in seeds) for k in edges}
    strength, support = Counter(), {}
    for _ in range(rounds):
        strength = Counter()
        for (w, v), n in edges.items():
            strength[w] += score[w, v] * n / (totals[w] + prior)
        support, fixed = {}, {}
        for w, v in edges:
            support[v] = 1 - (1 - support.get(v, 0.0)) * (1 - min(strength[w], 0.999999))
            fixed[v] = max(fixed.get(v, 0.0), float((w, v) in seeds))
        score = {(w, v): max(fixed[v], support[v]) for w, v in edges}
    return {(i, a, e) for i, a, e, w, v in places if strength[w] >= confidence or support.get(v, 0.0) >= confidence}


def test_discovered_spans_against_plain_python(spark):
    d = "/root/testdata/sf0.001"
    rows = table(spark, d, "documents").select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    texts += [f"the badge no :   \t\n {' ' * 60}= \"K{i}7-22{i}-QX{i}99\" of the day" for i in range(4)]
    texts += [f"write to badge   no: x{i}@mail.org again" for i in range(9)] + ["see K17-221-QX199 again", "no = \"K9-9999-Z1\""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {(r.doc_id, s.start, s.end) for r in pd.spans(df).collect() for s in r.spans if s.kind == 4}
    assert got == _graph_spans(texts)


def test_every_token_secret_is_found_and_masked(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    secret = re.compile(r'token = "([0-9a-f]{40})"')
    wanted = {(r.doc_id, m.start(1), m.end(1)) for r in docs.collect() for m in secret.finditer(r.text or "")}
    got = {(r.doc_id, s.start, s.end) for r in pd.spans(docs).collect() for s in r.spans if s.kind == 4}
    assert len(wanted) >= 10 and got == wanted
    assert not any(secret.search(r.text or "") for r in pd.mask(docs).collect())
