from __future__ import annotations

import tracemalloc
from collections import Counter
from hashlib import sha256
from inspect import signature

import numpy as np
import pytest

from clvspark.llm import pieces
from clvspark.llm.piece_lattice import Decoder, Sampler, Vocabulary, sample_long

from .cases import ROWS, documents, empty


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary.load(pieces.MODEL)


def _encode(vocab, texts, keys=None, seed=0):
    out = list(Sampler(vocab, seed).encode(np.arange(len(texts)) if keys is None else np.array(keys), texts))
    return np.concatenate([x[1] for x in out]), np.concatenate([x[2] for x in out])


def test_round_trip_and_edges(spark, vocab):
    rows = pieces.encode(documents(spark), decoded=True).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, _ in ROWS)
    assert all((r.pieces is None) == (r.text is None) for r in rows)
    again = pieces.decode(pieces.encode(documents(spark)))
    assert Counter((r.doc_id, r.text) for r in again.collect()) == Counter((i, t) for i, t, _ in ROWS)
    assert pieces.encode(empty(spark)).count() == 0
    nines = {tuple(r.pieces) for r in rows if r.doc_id == 9}
    assert len(nines) == 1


def test_reproducible_by_key(vocab):
    texts = ["water under the bridges of the town"] * 60
    ids, counts = _encode(vocab, texts)
    parts = [tuple(x) for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert len(set(parts)) > 5
    alone, _ = _encode(vocab, texts[:1], keys=[37])
    assert tuple(alone) == parts[37]


def test_draws_follow_the_lattice(vocab):
    number = {p: i for i, p in enumerate(vocab.pieces) if p}

    def ways(text):
        if not text:
            yield ()
        for n in range(1, len(text) + 1):
            if text[:n] in number:
                yield from ((number[text[:n]], *rest) for rest in ways(text[n:]))

    weight = {w: np.prod(vocab.weights[list(w)]) for w in ways("▁other")}
    total = sum(weight.values())
    draws = 20_000
    ids, counts = _encode(vocab, ["other"] * draws)
    got = Counter(tuple(x) for x in np.split(ids, np.cumsum(counts)[:-1]))
    assert set(got) <= set(weight)
    assert all(abs(got[w] / draws - weight[w] / total) < 0.015 for w in weight)


def test_long_segments_decode(vocab):
    text = "▁" + "abcabd" * 40
    assert Counter("".join(vocab.pieces[c] for c in sample_long(vocab, text, s)) for s in range(5)) == {text: 5}
    ids, counts = _encode(vocab, ["q" * 500 + "\n é"])
    data, _ = Decoder(vocab).decode(ids, counts)
    assert data.tobytes().decode() == "q" * 500 + "\n é"


def test_memory_of_a_task_is_bounded(vocab):
    rng = np.random.default_rng(5)
    words = [w.replace("▁", "") for w in vocab.pieces if w.isalpha() or w.startswith("▁")]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(1200)]
    _encode(vocab, texts[:1])  # builds the tables
    block = signature(pieces.encode).parameters["block"].default
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        parts = sum(len(counts) for _, _, counts in Sampler(vocab, 0, block).encode(np.arange(len(texts)), texts))
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert parts == len(texts) and sum(map(len, texts)) > 2_000_000 and peak < 60e6


def test_query_digest(spark):
    from clvspark.llm import queries
    from clvspark.llm.frames import table
    d = "/root/testdata/sf0.001"
    texts = dict(table(spark, d, "documents").select("doc_id", "text").collect())
    for r in queries.op1_sentencepiece(spark, d).collect():
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest() and r.n_pieces == len(r.pieces)
