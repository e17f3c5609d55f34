"""Near-duplicate vectors by a pivot-permutation index.

1. Pivots are vectors of the table, chosen by a hash and thinned so that no
   two are close; their number grows with the square root of the rows, up to
   ``max_pivots``, which bounds what reaches the driver.
2. Each vector is described by its ``nearest`` pivots in order of cosine.
   Inverted lists are kept for pairs of pivots, so members of one list share
   at least two: vectors whose shared-pivot count is lower never meet.
3. Within a list all members are compared in double precision, block against
   block. A pair counts in the list of the two smallest pivots it shares, so
   once. A task gives link counts per vector and, for the components, at
   most one link for each two groups that meet: not all pairs.

Equal vectors are one class, counted with its size. Every row is indexed.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components link with nothing, and so do vectors of different
length; repeated rows are vectors of their own; a null id links with nothing
and is kept. Other columns are ignored.
"""

from __future__ import annotations

import math
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.llm.cells import by_cell, deal
from clvspark.llm.components import components
from clvspark.session import materialize


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length one in double precision, or None if it cannot link."""
    if not values or any(x is None for x in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top  # no overflow or underflow of the squares
    return v / np.sqrt(v @ v)


def normalised(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """(key, digest, unit): ``unit`` the bytes of the unit vector, null if it cannot link."""

    def run(batches):
        for batch in batches:
            units = [unit(v) for v in batch.column("v").to_pylist()]
            data = [u.tobytes() if u is not None else None for u in units]
            digest = [blake2b(d, digest_size=16).digest() if d else None for d in data]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(digest, pa.binary()), pa.array(data, pa.binary())],
                                             names=["key", "digest", "unit"])

    return vectors.select(F.col(key).cast("long").alias("key"), F.col(embedding).cast("array<double>").alias("v")).mapInArrow(
        run, "key long, digest binary, unit binary")


def choose_pivots(classes: DataFrame, count: int, rows: int, apart: float = 0.7, seed: int = 23) -> dict[int, np.ndarray]:
    """By vector length in bytes, up to ``count`` pivots no two of which have a cosine above ``apart``."""
    share = min(1.0, 2 * count / max(1, rows))
    drawn = classes.select("unit", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)).alias("at")).filter(
        F.col("at") <= int(share * (1 << 30))).collect()
    found: dict[int, list[np.ndarray]] = {}
    for r in sorted(drawn, key=lambda r: (r["at"], bytes(r["unit"])))[:2 * count + 64]:
        v = np.frombuffer(r["unit"], np.float64)
        own = found.setdefault(len(v), [])
        if len(own) < count and (not own or (np.stack(own) @ v).max() < apart):
            own.append(v)
    return {n: np.stack(p) for n, p in found.items()}


def describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """(key, copies, unit, order, lists): the nearest pivots in order, and the pairs of them as list numbers."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            orders, lists = [], []
            for data in batch.column("unit").to_pylist():
                v = np.frombuffer(data, np.float64)
                p = shared.value.get(len(v))
                if p is None:  # no vector of this length was drawn: one list for all of them, no pivots to share
                    orders.append([])
                    lists.append([-len(v)])
                    continue
                near = p @ v
                m = min(nearest, len(near))
                top = np.argpartition(-near, m - 1)[:m]
                top = top[np.lexsort((top, -near[top]))]
                orders.append(top.tolist())
                pairs = combinations(sorted(top.tolist()), 2) if m > 1 else [(0, 0)]
                lists.append([(len(v) << 40) + (a << 20) + b for a, b in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), batch.column("unit"),
                 pa.array(orders, pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.int64()))],
                names=["key", "copies", "unit", "order", "lists"])

    return classes.select("key", "copies", "unit").mapInArrow(
        run, "key long, copies long, unit binary, order array<int>, lists array<long>")


def _build(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], names=["a", "b", "n"])


def verified(described: DataFrame, least: float, cell: int) -> DataFrame:
    """(a, b, n): link counts of a vector (b null) and links (n null) that hold its components together."""

    def compare(now: tuple, rows: list[tuple]) -> list[tuple]:
        bucket, i, j = now
        own, key, copies, data, order = zip(*rows, strict=True)
        own, copies = np.array(own), np.array(copies)
        units = np.stack([np.frombuffer(d, np.float64) for d in data])
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        group, count, found = np.arange(len(key)), np.zeros(len(key), np.int64), []
        tops = [sorted(o) for o in order]
        # members of one list that share no smaller pivot than the list's pair agree here
        a, b = (bucket >> 20) & 0xFFFFF, bucket & 0xFFFFF
        smaller = [frozenset(t for t in top if t < b and t != a) for top in tops]
        kinds = {s: k for k, s in enumerate(dict.fromkeys(smaller))}
        kind = np.array([kinds[s] for s in smaller])
        own_pair = np.array([[not (s & t) for t in kinds] for s in kinds])
        for start in range(0, len(left), 256):
            part = left[start:start + 256]
            near = (units[part] @ units[right].T >= least) & own_pair[kind[part]][:, kind[right]]
            near &= (part[:, None] < right[None, :]) if i == j else True
            for x, row in zip(part, near, strict=True):
                y = right[row]
                if not len(y):
                    continue
                count[x] += copies[y].sum()
                count[y] += copies[x]
                for g in np.unique(group[y]):
                    if g != group[x]:
                        found.append((key[x], key[y[group[y] == g][0]], None))
                        group[group == g] = group[x]
        return found + [(key[k], None, int(count[k])) for k in np.flatnonzero(count)]

    listed = described.select("key", F.explode("lists").alias("bucket"))
    sizes = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = listed.join(sizes, "bucket").join(described.select("key", "copies", "unit", "order"), "key")
    return deal(members, cell, "key", "copies", "unit", "order").mapInArrow(
        lambda batches: by_cell(batches, compare, _build), "a long, b long, n long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", least: float = 0.95,
                 nearest: int = 6, per_root: float = 4.0, max_pivots: int = 16_384, cell: int = 2000) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    rows = materialize(normalised(vectors, key, embedding))
    classes = materialize(rows.filter("unit IS NOT NULL AND key IS NOT NULL").groupBy("digest").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")))
    n = classes.count()
    pivots = choose_pivots(classes, max(8, min(max_pivots, math.ceil(per_root * math.sqrt(n)))), n)
    described = materialize(describe(classes, pivots, nearest))
    found = materialize(verified(described, least, cell))
    label = components(found.filter("n IS NULL"))
    links = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("near"))
    of_class = classes.select("digest", F.col("key").alias("rep"), "copies").join(links, "rep", "left").join(
        label.withColumnRenamed("node", "rep"), "rep", "left")
    # a null id takes no part, though its vector may equal another's
    joined = rows.select("key", F.when(F.col("key").isNotNull(), F.col("digest")).alias("digest")).join(of_class, "digest", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "rep", "key"))
    return joined.select(
        F.col("key").alias(key), (F.coalesce("near", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
