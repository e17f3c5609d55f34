from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np

from clvspark.llm import fill_middle as fim
from clvspark.llm import queries
from clvspark.llm.frames import table

from .cases import documents, empty


def _plain(key, text, rate=100, spm=50):
    """The contract, text by text: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def _check(df, **options):
    got = fim.restored(fim.fill_in_middle(df, **options)).collect()
    wanted = sorted((str(r.doc_id), *map(str, _plain(r.doc_id, r.text, **options)), r.text or "") for r in df.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), *map(str, r[1:])) for r in got) == wanted


def test_hard_rows_and_random_texts(spark):
    r = random.Random(5)
    rows = [(i, "".join(r.choice(["a", "\n", "<", ">", "P", "S", "M", "é", "\U0001F600", "\r", "<P", "S>", "line "])
                        for _ in range(r.randint(0, 40)))) for i in range(600)]
    rows += [(1000, "\n\n\n"), (1001, "one line"), (1002, "a<P>b\nc"), (1003, "<<M"), (1004, "x\n" * 60_000), (1005, "long é" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _check(df)
    _check(df, rate=40, spm=20)


def test_edges(spark):
    docs = documents(spark)
    _check(docs)
    assert fim.fill_in_middle(empty(spark)).count() == 0 and fim.restored(fim.fill_in_middle(empty(spark))).count() == 0
    text_keys = docs.withColumn("doc_id", docs.text)
    assert fim.fill_in_middle(text_keys).count() == docs.count()


def test_blocks_carry_the_shift(monkeypatch):
    monkeypatch.setattr(fim, "_BLOCK", 7)
    texts = [f"{i}\nsecond line {i}\n\nlast é{i}".encode() for i in range(50)] + [b"", b"<M>"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    drawn = np.random.default_rng(3).integers(0, 1 << 32, (len(texts), 4))
    out, places, form, *_ = fim.transform(np.frombuffer(b"".join(texts), np.uint8), offsets, drawn, 100, 50)
    back, ends = fim.restore(out, places, form)
    assert back.tobytes() == b"".join(texts) and ends.tolist() == offsets.tolist() and set(form) == {0, 1, 2}


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = dict(table(spark, d, "documents").select("doc_id", "text").collect())
    rows = queries.op11_fill_in_middle(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *counts, output = _plain(r.doc_id, texts[r.doc_id])
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == counts
        assert r.output_sha256 == sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == sha256((texts[r.doc_id] or "").encode()).hexdigest()
