from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clvspark.llm import language_id, queries
from clvspark.llm.byte_gru import ByteGRU
from clvspark.llm.frames import table

from .cases import documents, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op9_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = ByteGRU(3, hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = rng.integers(97, 101, (6, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = net._loss_grads(x, y)
    for name in ("Uf", "Ub", "V", "Ef"):
        at = (97, 5) if name == "Ef" else (1, 2)
        w = net.w[name]
        keep, step = w[at], 1e-3
        w[at] = keep + step
        up, _ = net._loss_grads(x, y)
        w[at] = keep - step
        down, _ = net._loss_grads(x, y)
        w[at] = keep
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-3


def test_every_byte_counts_and_blocks_do_not_matter():
    rng = np.random.default_rng(1)
    net, data = ByteGRU(3), rng.integers(32, 255, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 1, 300, 5000])
    a, b = language_id.pooled(net, data, offsets, 128, 2048), language_id.pooled(net, data, offsets, 128, 3)
    assert np.allclose(a, b, atol=1e-5) and np.allclose(a[1:].sum(axis=1), 1, atol=1e-4) and (a[0] == 0).all()


def test_edges(spark):
    docs = documents(spark)
    model = language_id.fit(docs, steps=5)
    rows = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (2, 3, 4, 5)) and rows[6].lang_pred != "und"
    assert language_id.predict(empty(spark), model).count() == 0
    none = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    carried = language_id.predict(docs, model, carry=docs.columns, names=("_l", "_s"))
    assert carried.columns == [*docs.columns, "_l", "_s"] and carried.count() == docs.count()
