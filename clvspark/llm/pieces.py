"""Sampled piece encoding, and decoding, of whole texts.

``encode`` draws one segmentation per text by forward filtering and backward
sampling over the piece lattice, seeded by the row's key: the same key, text
and seed give the same pieces anywhere. ``decode`` restores every text
exactly: characters without a piece travel as their UTF-8 bytes' pieces.

Defined results: a null text has null pieces, an empty text an empty array;
repeated rows get equal pieces; a null key counts as 0 when seeding. Other
columns are ignored. The vocabulary (a few tens of thousands of pieces, read
on the driver from ``model_path``) is broadcast; the corpus never is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.llm.piece_lattice import Decoder, Sampler, Vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_ROWS = 1000


def _lists(values: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32),
                       mask=np.concatenate([null, [False]]))
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model_path: str = MODEL,
           theta: float = 0.8, seed: int = 0, block: int = 500_000, decoded: bool = False) -> DataFrame:
    """(key, pieces array<int>) of every row; a task works on about ``block`` characters at a time, of ``_ROWS`` rows at most.

    With ``decoded`` there is a third column ``text``: what decoding the
    pieces gives, made in the same task so that the pieces travel once.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path, theta))
    columns = ["key", "pieces"] + ["text"] * decoded

    def run(batches):
        sampler, decoder = Sampler(vocab.value, seed, block), Decoder(vocab.value)
        for part in (batch.slice(first, _ROWS) for batch in batches for first in range(0, batch.num_rows, _ROWS)):
            keys = part.column("key").fill_null(0).to_numpy(zero_copy_only=False)
            null = part.column("text").is_null().to_numpy(zero_copy_only=False)
            at = 0
            for rows, ids, counts in sampler.encode(keys, part.column("text").to_pylist()):
                out = [part.column("key").slice(at, rows), _lists(ids, counts, null[at:at + rows])]
                if decoded:
                    out.append(_texts(decoder, ids, counts, null[at:at + rows]))
                yield pa.RecordBatch.from_arrays(out, names=columns)
                at += rows

    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "key long, pieces array<int>" + ", text string" * decoded).withColumnRenamed("key", key)


def _texts(decoder: Decoder, ids: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.Array:
    data, offsets = decoder.decode(ids, counts)
    valid = pa.py_buffer(np.packbits(~null, bitorder="little")) if null.any() else None
    return pa.Array.from_buffers(pa.string(), len(counts), [
        valid, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def decode(encoded: DataFrame, key: str = "doc_id", pieces: str = "pieces", model_path: str = MODEL,
           keep: bool = True, block: int = 1000) -> DataFrame:
    """(key, text) of every row, and the pieces too if ``keep``; null pieces give a null text."""
    vocab = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    def run(batches):
        decoder = Decoder(vocab.value)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                lists = part.column("pieces")
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = _texts(decoder, ids, counts, lists.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column("key"), lists, texts], names=["key", "pieces", "text"])

    source = encoded.select(F.col(key).cast("long").alias("key"), F.col(pieces).cast("array<int>").alias("pieces"))
    out = source.mapInArrow(run, "key long, pieces array<int>, text string").withColumnRenamed("key", key)
    return out if keep else out.drop("pieces")
