"""Removal of passages that repeat byte for byte, by suffix order and longest previous factors.

1. Every window of ``width`` bytes picks an anchor, a string of ``gram``
   bytes inside it, by content alone; windows in a row that pick the same
   place form a run. Equal windows have equal anchors, so only runs that
   share an anchor can hold repeats.
2. Runs with equal spans repeat whole. They are counted with partial
   aggregation, and each distinct span goes on once.
3. Distinct spans that share an anchor are compared inside tasks: their
   suffixes are sorted and longest previous factors tell which windows have
   an earlier equal, and which any other. An anchor with more than
   ``hot`` distinct spans is not gathered: its windows are grouped by their
   128-bit hashes instead, which spreads them over tasks.

``keep="first"`` leaves the first occurrence (by key, then text digest, then
position); ``keep="none"`` removes all of them. Matches are judged on the
input and do not cross documents.

Defined results: a null or empty text has no bytes; texts shorter than
``width`` lose nothing; repeated rows repeat each other; a null key is an
ordinary value. Other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.llm.passages import Powers, merged, previous_factors, runs, stretches, window_hashes
from clvspark.session import materialize

_SIGNED = np.int64


def _digest(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _rows(columns: dict[str, tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[n]) for n in kinds], names=list(kinds))


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def text_runs(docs: DataFrame, key: str, text: str, width: int, gram: int) -> DataFrame:
    """(key, digest, anchor, span, first, last) of all runs of all texts."""
    names = ["key", "digest", "anchor", "span", "first", "last"]

    def run(batches):
        powers = Powers()
        for batch in batches:
            keys, digests, found, held = [], [], [], 0
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if len(t) < width:
                    continue
                with np.errstate(over="ignore"):
                    got = runs(np.frombuffer(t, np.uint8), width, gram, powers)
                keys += [k] * got.shape[1]
                digests.append(np.full(got.shape[1], _digest(t)))
                found.append(got)
                held += got.shape[1]
                if held > 50_000:
                    yield _run_batch(keys, digests, found, names)
                    keys, digests, found, held = [], [], [], 0
            if found:
                yield _run_batch(keys, digests, found, names)

    return _source(docs, key, text).mapInArrow(run, "key long, digest long, anchor long, span long, first int, last int")


def _run_batch(keys, digests, found, names) -> pa.RecordBatch:
    anchor, span, first, last = np.concatenate(found, axis=1)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(np.concatenate(digests)), pa.array(anchor.view(_SIGNED)),
         pa.array(span.view(_SIGNED)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], names=names)


def _span_bytes(wanted: DataFrame, docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``wanted`` (key, digest, anchor, span, n, hot, first, last) with the spans' bytes, cut out in one pass over the texts."""
    columns = ("anchor", "span", "n", "hot", "first", "last")
    grouped = wanted.groupBy("key", "digest").agg(F.collect_list(F.struct(*columns)).alias("wanted"))
    kinds = {"key": pa.int64(), "digest": pa.int64(), "anchor": pa.int64(), "n": pa.int64(), "hot": pa.bool_(),
             "first": pa.int32(), "last": pa.int32(), "bytes": pa.binary()}

    def cut(batches):
        for batch in batches:
            out = {n: [] for n in kinds}
            for k, t, d, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "digest", "wanted")), strict=True):
                if _digest(t) != d:
                    continue  # the same key with another text
                for s in spans:
                    for name in ("anchor", "n", "hot", "first", "last"):
                        out[name].append(s[name])
                    out["key"].append(k)
                    out["digest"].append(d)
                    out["bytes"].append(t[s["first"]:s["last"] + width])
            yield _rows(out, kinds)

    source = _source(docs, key, text).filter(F.length("text") >= width).alias("t")
    joined = source.join(grouped.withColumnRenamed("key", "k"), F.expr("t.key <=> k")).select("key", "text", "digest", "wanted")
    # rows with equal key and text would give their spans twice
    return joined.mapInArrow(cut, "key long, digest long, anchor long, n long, hot boolean, first int, last int, bytes binary"
                             ).dropDuplicates(["key", "digest", "first"])


def _compared(spans: DataFrame, width: int, first_stays: bool, most: int = 1_500_000) -> DataFrame:
    """Intervals (key, digest, start, end) from spans gathered by anchor, by longest previous factors."""
    kinds = {"key": pa.int64(), "digest": pa.int64(), "start": pa.int32(), "end": pa.int32()}

    def compare(batches):
        rows, size, anchor = [], 0, None

        def solved():
            out = {n: [] for n in kinds}
            if rows:
                earlier, other = previous_factors([r[5] for r in rows], width)
                for (k, d, n, first, _, _), e, o in zip(rows, earlier, other, strict=True):
                    if not first_stays and n > 1:
                        continue  # removed whole already
                    for a, b in stretches(e if first_stays else o, first, width):
                        for name, v in zip(kinds, (k, d, a, b), strict=True):
                            out[name].append(v)
            return _rows(out, kinds)

        for batch in batches:
            for a, k, d, n, first, last, data in zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "key", "digest", "n", "first", "last", "bytes")), strict=True):
                if a != anchor and size > most:
                    yield solved()
                    rows, size = [], 0
                anchor = a
                rows.append((k, d, n, first, last, data))
                size += len(data)
        yield solved()

    grouped = spans.repartition("anchor").sortWithinPartitions("anchor", "key", "digest", "first")
    return grouped.mapInArrow(compare, "key long, digest long, start int, end int")


def _hashed(spans: DataFrame, width: int, first_stays: bool) -> DataFrame:
    """The same for spans of hot anchors: windows grouped by hash, with partial aggregation."""
    kinds = {"x": pa.int64(), "y": pa.int64(), "key": pa.int64(), "digest": pa.int64(), "n": pa.int64(), "start": pa.int32()}

    def windows(batches):
        powers = Powers()
        for batch in batches:
            for k, d, n, first, data in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "n", "first", "bytes")), strict=True):
                with np.errstate(over="ignore"):
                    x, y = window_hashes(np.frombuffer(data, np.uint8), width, powers).view(_SIGNED)
                yield _rows({"x": x, "y": y, "key": [k] * len(x), "digest": [d] * len(x), "n": [n] * len(x),
                             "start": np.arange(first, first + len(x), dtype=np.int32)}, kinds)

    each = spans.mapInArrow(windows, "x long, y long, key long, digest long, n long, start int")
    least = each.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "digest", "start")).alias("at")).filter("c > 1")
    hit = each.join(least, ["x", "y"])
    hit = hit.filter(F.struct("key", "digest", "start") != F.col("at")) if first_stays else hit.filter("n = 1")
    return hit.select("key", "digest", "start", (F.col("start") + width).alias("end"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 200, keep: str = "first",
            gram: int = 40, hot: int = 8000) -> DataFrame:
    """(key, digest, start, end): byte intervals to remove, not yet merged; ``digest`` tells texts of one key apart."""
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    first_stays = keep == "first"
    every = text_runs(docs, key, text, width, gram)
    shared = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor")
    found = materialize(every.join(shared, "anchor"))
    # equal rows (key, text) are occurrences of their own, but one place to remove from
    spans = found.groupBy("anchor", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "digest", "first", "last")).alias("at"))
    spans = materialize(spans.select("anchor", "span", "n", "at.*"))
    whole = found.join(spans.filter("n > 1").select("anchor", "span", F.struct("key", "digest", "first").alias("at")), ["anchor", "span"])
    if first_stays:
        whole = whole.filter(~F.struct("key", "digest", "first").eqNullSafe(F.col("at")))
    whole = whole.select("key", "digest", F.col("first").alias("start"), (F.col("last") + width).alias("end"))

    meeting = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    wanted = spans.join(meeting, "anchor").withColumn("hot", F.col("m") > hot)
    parts = materialize(_span_bytes(wanted, docs, key, text, width))
    return materialize(whole.unionByName(_compared(parts.filter("NOT hot"), width, first_stays)).unionByName(
        _hashed(parts.filter("hot"), width, first_stays)))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_bytes, spans array<struct<start, end>>, kept binary) of every row: maximal removed runs and what is left."""
    found = repeats(docs, key, text, **options).groupBy("key", "digest").agg(
        F.collect_list(F.struct("start", "end")).alias("found")).groupBy("key").agg(
        F.collect_list(F.struct("digest", "found")).alias("by_text"))
    joined = _source(docs, key, text).alias("t").join(
        found.withColumnRenamed("key", "k"), F.expr("t.key <=> k"), "left").select("key", "text", "by_text")
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            spans, kept, sizes = [], [], []
            for t, by_text in zip(batch.column("text").to_pylist(), batch.column("by_text").to_pylist(), strict=True):
                d = _digest(t) if by_text else None
                gone = merged([(x["start"], x["end"]) for g in by_text or [] if g["digest"] == d for x in g["found"]])
                left, at = [], 0
                for a, b in gone:
                    left.append(t[at:a])
                    at = b
                kept.append(b"".join([*left, t[at:]]))
                spans.append([{"start": a, "end": b} for a, b in gone])
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(place)),
                                              pa.array(kept, pa.binary())], names=["key", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, "key long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary").withColumnRenamed("key", key)
