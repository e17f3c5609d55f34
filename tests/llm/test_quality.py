from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import functions as F

from clvspark.llm import quality_rules_ensemble as ensemble
from clvspark.llm import queries, text_rules
from clvspark.llm.frames import table

from .cases import documents, empty

SF = "/root/testdata/sf0.01"


def _base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_rules_on_whole_table(spark):
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = queries.op7_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert _base(texts[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.kept and r.base_failed)


def test_frequent_lines_reject_depleted_documents(spark):
    line = "subscribe to the weekly letter of this site and follow it everywhere you can "
    own = "a text of its own number {} with quite some words that stand nowhere else number {} at all "
    rows = [(i, line * 3 + "\nown" + str(i), "h") for i in range(30)]
    rows += [(100 + i, line + "\n" + (own * 4).format(*[i * 10 + k for k in range(8)]), "h") for i in range(30)]
    rows += [(200 + i, line * 3 + "\nown" + str(i), None) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in text_rules.judge(df, max_repeat=100).collect()}
    assert not any(kept[i] for i in range(30)) and all(kept[100 + i] for i in range(30)) and all(kept[200 + i] for i in range(5))
    left = dict(text_rules.without_frequent_lines(df).collect())
    assert left[3] == "own3" and left[200].startswith("subscribe")


def test_rule_edges(spark):
    rows = text_rules.judge(documents(spark)).collect()
    assert len(rows) == documents(spark).count() and text_rules.judge(empty(spark)).count() == 0
    assert {(r.n_words, r.base_failed) for r in rows if r.doc_id in (2, 3, 4)} == {(0, True)}


def test_classifier_on_held_out_rows(spark):
    rows = queries.op4_quality_classifier(spark, SF).join(table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(good) > 20 and len(bad) > 5
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > 0.9
    assert sum(s >= 0.3 for s in good) / len(good) > 0.95


def test_classifier_edges(spark):
    docs = documents(spark)
    model = ensemble.fit(docs.withColumn("quality", F.lit(None).cast("int")))
    assert {round(r.score, 6) for r in ensemble.score(docs, model).collect()} == {0.5}
    one = ensemble.fit(docs.withColumn("quality", F.lit(1)))
    assert all(r.score > 0.99 for r in ensemble.score(docs, one).collect())
    assert ensemble.score(empty(spark), one).count() == 0
    stats = ensemble.statistics(docs, "text").collect()
    assert all(x is not None and x == x for r in stats for x in r)
