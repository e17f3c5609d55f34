"""Language identification by a bidirectional recurrent network over bytes.

``fit`` learns from a bounded sample of labelled texts; ``predict`` runs the
network over every byte of every text and averages the per-byte class
probabilities per document. Spark spreads the documents; a task works on
Arrow batches, in blocks of a fixed number of byte segments, so its memory
does not depend on the length of a text.

Defined results: a null text, an empty text and a text without letters give
``und`` with score 0. Repeated rows give repeated results. Without any
labelled row every text gives ``und``. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clvspark.llm.byte_gru import ByteGRU

UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """Learned labels and the network (None without training rows)."""

    labels: list[str]
    network: ByteGRU | None


def _pieces(text: str, count: int, chars: int) -> Column:
    """``count`` slices of ``chars`` characters spread over the whole text."""
    length = F.greatest(F.length(text) - chars, F.lit(0))
    return F.array(*[F.substring(F.col(text), (F.floor(length * (i + 0.5) / count) + 1).cast("int"), F.lit(chars))
                     for i in range(count)])


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        max_documents: int = 6000, pieces: int = 4, piece_chars: int = 150, steps: int = 250,
        segment: int = 64, hidden: int = 8, seed: int = 17) -> LanguageModel:
    """Train on about ``max_documents`` labelled texts, and no more than that.

    They are the rows whose hash of the key falls under a threshold set
    from the row count, so what reaches the driver does not grow with the
    table: of each chosen text ``pieces`` slices of ``piece_chars``
    characters, spread over its length.
    """
    known = labelled.filter(F.col(label).isNotNull())
    share = min(1.0, max_documents / max(1, known.count()))
    rows = (known.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"),
                         F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)).alias("at"))
            .filter((F.col("at") < int(share * (1 << 30)) + 1) & F.col("text").rlike(r"\p{L}"))
            .select("label", _pieces("text", pieces, piece_chars).alias("pieces"), "at").collect())
    rows = sorted(rows, key=lambda r: (r["at"], r["label"], r["pieces"]))[:max_documents]
    labels = sorted({r["label"] for r in rows})
    if not labels:
        return LanguageModel([], None)
    number = {name: i for i, name in enumerate(labels)}
    x, y = [], []
    for r in rows:
        for piece in dict.fromkeys(r["pieces"]):
            data = piece.encode()
            if len(data) < segment:  # a short text is repeated to fill a segment
                data = (data * (segment // max(1, len(data)) + 1))[:segment]
            for at in range(0, len(data) - segment + 1, segment):
                x.append(np.frombuffer(data[at:at + segment], np.uint8))
                y.append(number[r["label"]])
    network = ByteGRU(len(labels), hidden, seed)
    return LanguageModel(labels, network.fit(np.stack(x), np.array(y), steps=steps))


def pooled(network: ByteGRU, data: np.ndarray, offsets: np.ndarray, segment: int, block: int) -> np.ndarray:
    """Mean class probabilities per text; text i is ``data[offsets[i]:offsets[i + 1]]``."""
    lengths = np.diff(offsets)
    counts = -(-lengths // segment)
    owner = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][owner] + nth * segment
    size = np.minimum(segment, offsets[1:][owner] - start)
    by_size = np.argsort(-size, kind="stable")  # whole segments first, then tails of like length
    sums = np.zeros((len(lengths), network.classes))
    for at in range(0, len(by_size), block):
        chosen = by_size[at:at + block]
        width = int(size[chosen[0]])
        index = start[chosen][None, :] + np.arange(width)[:, None]
        x = data[np.minimum(index, len(data) - 1)].astype(np.intp)
        p = network.pooled_probabilities(x, size[chosen])
        for c in range(network.classes):
            sums[:, c] += np.bincount(owner[chosen], weights=p[c], minlength=len(lengths))
    return sums / np.maximum(lengths, 1)[:, None]


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text",
            segment: int = 128, block: int = 2048, carry: list[str] | None = None,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """(key, lang_pred, score) for every row of ``docs``, or the columns ``carry`` in place of the key;
    ``names`` are those of the two new columns.

    A text is read in segments of ``segment`` bytes, each with a fresh
    state; all of its bytes are labelled.
    """
    kept = carry or [key]
    read = F.when(F.col(text).rlike(r"\p{L}"), F.col(text).cast("binary"))
    if model.network is None:
        return docs.select(*kept, F.lit(UNDETERMINED).alias(names[0]), F.lit(0.0).alias(names[1]))
    source = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], read.alias("read"))
    labels, network = np.array(model.labels, dtype=object), model.network
    schema = StructType([*source.schema.fields[:-1], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            texts = batch.column("read")
            texts = pa.concat_arrays([texts]) if texts.offset else texts
            offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_binary(texts.type) else np.int32)
            offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            buffer = texts.buffers()[2]
            data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(1, np.uint8)
            p = pooled(network, data, offsets, segment, block)
            best, missing = p.argmax(axis=1), np.diff(offsets) == 0
            found = np.where(missing, UNDETERMINED, labels[best])
            score = np.where(missing, 0.0, np.clip(p[np.arange(len(p)), best], 0.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(score, pa.float64())],
                names=schema.names)

    return source.mapInArrow(run, schema).toDF(*kept, *names)
