"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

1. One pass over the texts gives, per document, the size and digest of its
   shingle set, its band keys and a one-byte-per-coordinate sketch.
   Documents with equal sets are one class, represented by the smallest key.
2. Representatives that share a band key form a bucket. Each is paired with
   the smallest key in its buckets, and the pairs are confirmed on the full
   sets, recomputed from the texts of candidates only.
3. A bucket is settled when links already connect its members. In the others
   further stars around members drawn by a hash come first; what then still
   holds several components is compared whole: block against block by
   sketch, and members near one of another component on their full sets.
   A task gives at most one link for each two components that meet.

So no pairs are formed within a group of copies that hang together, and no
candidate is dropped: the result is the components of all confirmed links
among documents that share a band.

Defined results: a null or empty text, or one without words, has no
shingles and links with nothing; repeated rows each get a result row, and a
repeated key has the links of all its rows; a null key links with nothing
and is kept. Other columns are ignored.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.llm.cells import by_cell, deal
from clvspark.llm.components import components
from clvspark.llm.frames import keyed_bytes
from clvspark.llm.shingles import band_keys, intersection, shingle_sets, signatures
from clvspark.session import materialize

_FEATURES = "key long, n long, digest binary, bands array<long>, sketch binary"


def banding(similarity: float, miss: float = 1e-5, coordinates: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which a pair at ``similarity``
    shares no band with probability at most ``miss``, within ``coordinates``."""
    best = (math.ceil(math.log(miss) / math.log(max(1e-12, 1 - similarity))), 1)
    for rows in range(2, 33):
        p = similarity ** rows
        bands = math.ceil(math.log(miss) / math.log1p(-p)) if p < 1 else 1
        if bands * rows <= coordinates:
            best = (bands, rows)
    return best


def features(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int, block: int = 500) -> DataFrame:
    """Per row: key, n (shingles), digest of the set, band keys, sketch; ``block`` texts at a time."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                sets = shingle_sets(part.column("text").to_pylist(), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                signature = signatures([sets[i] for i in full], bands * rows)
                band = dict(zip(full, band_keys(signature, bands, rows), strict=True))
                sketch = dict(zip(full, signature.astype(np.uint8), strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([band.get(i) for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([sketch[i].tobytes() if i in sketch else None for i in range(len(sets))], pa.binary()),
                ], names=["key", "n", "digest", "bands", "sketch"])

    return keyed_bytes(docs, key, text).mapInArrow(run, _FEATURES)


def confirm(pairs: DataFrame, docs: DataFrame, key: str, text: str, words: int, percent: int,
            recent: int = 64, block: int = 500) -> DataFrame:
    """The pairs (a, b) whose full sets reach ``percent``; texts travel, sets are made where they are compared,
    ``block`` pairs at a time."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = materialize(keyed_bytes(docs, key, text).join(wanted, "key", "left_semi"))

    def run(batches):
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                a, b = part.column("text_a").to_pylist(), part.column("text_b").to_pylist()
                for i, (x, y) in enumerate(zip(a, b, strict=True), at):
                    if x not in known:
                        if len(known) >= recent:
                            known.clear()
                        known[x] = shingle_sets([x], words)[0]
                    p, q = known[x], shingle_sets([y], words)[0]
                    both = intersection(p, q)
                    linked[i] = both > 0 and 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(linked)), batch.column("b").filter(pa.array(linked))], names=["a", "b"])

    of = lambda side: texts.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}"))
    return pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a").select(
        "a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _may_link(members: DataFrame, percent: int, coordinates: int, cell: int) -> DataFrame:
    """(bucket, key): members whose sketch comes near ``percent`` with one of another component.

    A pair counts in the first bucket that it shares. ``members`` has bucket,
    size, key, n, component, bands, sketch.
    """
    share = percent / 100
    least = share - 5 * math.sqrt(share * (1 - share) / coordinates)

    def compare(now: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        bucket, i, j = now
        own, key, n, component, bands, sketch = zip(*rows, strict=True)
        own, key, n, component, bands = map(np.array, (own, key, n, component, bands))
        sketch = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(key), -1)
        right = np.flatnonzero(own == j)
        flagged = np.zeros(len(key), bool)
        for x in np.flatnonzero(own == i):
            y = right[component[right] != component[x]]
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            if len(y):
                y = y[(sketch[y] == sketch[x]).mean(axis=1) >= least]
            if len(y):
                first = (bands[y] == bands[x]).argmax(axis=1)
                y = y[bands[x][first] == bucket]
                flagged[y] = True
                flagged[x] |= len(y) > 0
        return [(bucket, int(k)) for k in key[flagged]]

    return deal(members, cell, "key", "n", "component", "bands", "sketch").mapInArrow(
        lambda batches: by_cell(batches, compare, _pairs), "bucket long, key long").distinct()


def _joining(members: DataFrame, words: int, percent: int, cell: int) -> DataFrame:
    """Links (a, b) that join components, from full sets compared within each cell.

    ``members`` has bucket, size, key, component, text. Per cell at most one
    link for each two components that meet, so never all pairs of a group.
    """

    def compare(now: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        _, i, j = now
        own, key, component, texts = zip(*rows, strict=True)
        sets = shingle_sets(list(texts), words)
        sizes = np.array([len(s) for s in sets])
        root = {c: c for c in component}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        right = [k for k in range(len(key)) if own[k] == j]
        flat = np.concatenate([sets[k] for k in right]) if right else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(right)), sizes[right]) if right else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        found = []
        for x in (k for k in range(len(key)) if own[k] == i):
            if all(find(component[k]) == find(component[x]) for k in right):
                continue
            low, high = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
            width = high - low
            at = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
            both = np.bincount(owner[at], minlength=len(right))
            union = sizes[x] + sizes[right] - both
            for k in np.flatnonzero((both > 0) & (100 * both >= percent * union)):
                p, q = find(component[x]), find(component[right[k]])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    found.append((int(key[x]), int(key[right[k]])))
        return found

    return deal(members, cell, "key", "component", "text").mapInArrow(
        lambda batches: by_cell(batches, compare, _pairs), "a long, b long").distinct()


def _unsettled(shared: DataFrame, label: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that still hold several components; written as a table."""
    placed = shared.drop("component").join(label.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    return materialize(placed.join(several.select("bucket"), "bucket", "left_semi"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80, stars_more: int = 1, cell: int = 1000) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``.

    Documents link if 100 * intersection >= ``percent`` * union of their sets
    of ``words``-word shingles. ``component_id`` is the smallest key reached;
    ``kept`` marks the document with that key. ``stars_more`` and ``cell`` shape
    the work on unsettled buckets (step 3), not the result.
    """
    bands, rows = banding(percent / 100)
    found = materialize(features(docs, key, text, words, bands, rows))
    full = found.filter("n > 0 AND key IS NOT NULL")
    reps = materialize(full.groupBy("digest", "n").agg(
        F.min("key").alias("key"), F.min_by(F.struct("bands", "sketch"), "key").alias("one"))
        .select("digest", "key", "n", "one.bands", "one.sketch"))

    banded = reps.select("key", "n", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min(F.struct("key", "n")).alias("least"), F.max("key").alias("most"),
                                           F.count(F.lit(1)).alias("size")).filter("least.key <> most")
    shared = materialize(banded.join(buckets.select("bucket", "least", "size"), "bucket"))
    fits = F.expr(f"100 * least(n, least.n) >= {int(percent)} * greatest(n, least.n)")
    stars = shared.filter((F.col("key") != F.col("least.key")) & fits).groupBy(F.col("key").alias("b")).agg(
        F.min("least.key").alias("a")).select("a", "b")
    links = materialize(confirm(materialize(stars), docs, key, text, words, percent))
    label = components(links)

    for turn in range(stars_more):
        shared = _unsettled(shared, label)
        centre = shared.groupBy("bucket").agg(F.min_by(
            F.struct("key", "n", "component"), F.xxhash64("key", F.lit(turn))).alias("centre"))
        fits = F.expr(f"100 * least(n, centre.n) >= {int(percent)} * greatest(n, centre.n)")
        # one pair for each two components that meet; the others wait until it is known
        more = materialize(shared.join(centre, "bucket").filter((F.col("component") != F.col("centre.component")) & fits)
                           .groupBy("component", F.col("centre.component").alias("other")).agg(
                               F.min(F.struct(F.col("centre.key").alias("a"), F.col("key").alias("b"))).alias("pair"))
                           .select("pair.a", "pair.b").distinct())
        if not more.head(1):
            break
        links = materialize(links.unionByName(confirm(more, docs, key, text, words, percent)))
        label = components(links)

    members = _unsettled(shared, label).select("bucket", "size", "key", "component")
    near = materialize(_may_link(members.join(reps.select("key", "n", "bands", "sketch"), "key"), percent, bands * rows, cell))
    if near.head(1):
        sized = near.join(near.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket").join(
            members.select("bucket", "key", "component"), ["bucket", "key"])
        texts = keyed_bytes(docs, key, text).join(near.select("key").distinct(), "key", "left_semi")
        links = materialize(links.unionByName(_joining(
            sized.join(texts, "key").select("bucket", "size", "key", "component", "text"), words, percent, cell)))
        label = components(links)

    of_class = reps.select("digest", "n", F.col("key").alias("rep"))
    rep_label = label.select(F.col("node").alias("rep"), "component")
    every = found.select("key", "n", "digest").join(of_class, ["digest", "n"], "left").join(rep_label, "rep", "left")
    # a key that repeats with different texts belongs to several classes: they are one node
    return _joined_rows(every, key)


def _joined_rows(every: DataFrame, key: str) -> DataFrame:
    labelled = every.select("key", "n", F.coalesce("component", "rep", "key").alias("component"))
    several = labelled.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    if several.head(1):
        merged = components(several.select("a", "b").unionByName(several.select(F.col("key").alias("a"), "b")))
        labelled = labelled.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")),
                                 "component", "left").withColumn("component", F.coalesce("to", "component"))
    return labelled.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                           F.col("component").alias("component_id"),
                           F.coalesce(F.col("key") == F.col("component"), F.lit(True)).alias("kept"))
