"""Ranked lexical search over a length-stratified index.

The score of a document for an item is the sum over the item's terms,
repeats included, of ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``, where
w depends on the term and m, the normaliser, on the document's length alone.
So documents of equal m form a stratum in which tf alone decides a term's
impact: postings are kept by (stratum, term, tf), and an impact is
computed once for all members of a posting.

Index (``build``): strata are cut into blocks of about ``_BLOCK_TERMS`` terms
by a hash of the row, so no block grows with the table; a block's row of
the empty term lists its documents by id, postings refer to places in it.

Search (``search``): a stratum's bound for an item is its score if one
document had every term at the largest tf the stratum has for it. Every
item visits first the ``first`` strata of the highest bounds, which gives
its k-th best score so far; in the second round it visits those of the other
strata whose bound reaches that score. A stratum below it cannot hold a
better document, so the result is exact. A visit scores whole blocks,
many items at a time, and gives up to k rows per item and block.

Items are dealt in chunks of ``_CHUNK``, so the group of a task holds one
block and one chunk of items, whatever the number of items.

Defined results: null texts have no terms and are not found; items without
terms have no rows; fewer than k documents with a score above 0 give fewer
rows; equal scores rank by ascending id, null ids last; rows that share an
id are documents, or items, of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clvspark.session import materialize

#: Fixed numbers of the score.
_ONE, _TF, _M, _SLOPE, _WEIGHT = 1_000_000_000, 1000, 12, 25, 1000
_BLOCK_TERMS = 1_000_000
_BLOCK_DOCS = 16_384
_CHUNK = 256
_OUT_ROWS = 16_384  # postings that leave a worker at once

# everything but the characters of a term becomes a blank, and A-Z lower case
_KEEP = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()

_POSTINGS = "m long, block int, term string, tf int, members array<int>, docs array<long>"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order: maximal runs of ASCII letters and digits and of all that is not ASCII."""
    return text.translate(_KEEP).split()


def _counted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, words, tfs) of every row: its distinct terms, blanks between them, and how often each occurs."""
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            step = 256
            for lo in range(0, batch.num_rows, step):
                words, counts, totals, ends = [], [], [], [0]
                for i in range(lo, min(lo + step, batch.num_rows)):
                    found = Counter(terms_of(texts[i].as_py()))
                    words.append(b" ".join(found))
                    counts += found.values()
                    totals.append(found.total())
                    ends.append(len(counts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, len(totals)), pa.array(totals, pa.int64()), pa.array(words, pa.binary()).cast(pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int32()))], names=["key", "n", "words", "tfs"])

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, n long, words string, tfs array<int>")


@dataclass
class StratumIndex:
    """``postings`` (m, block, term, tf, members, docs), and N documents with terms.

    ``members`` are the places, in its block's ``docs``, of the documents that hold the term tf times. The row of the
    empty term holds ``docs`` (ids, ascending, null last).
    """

    postings: DataFrame
    documents: int
    key: str


def _blocks(rows: DataFrame) -> DataFrame:
    """Postings of rows (m, block, key, words, tfs) that come grouped by block and ordered by key."""

    def build(m: int, block: int, held: list) -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        term = pc.split_pattern(pa.concat_arrays([h[1] for h in held]), " ").flatten().dictionary_encode()
        tf = np.concatenate([h[2].flatten().to_numpy() for h in held])
        sizes = np.concatenate([pc.list_value_length(h[2]).to_numpy() for h in held])
        place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        code = term.indices.to_numpy()
        order = np.lexsort((place, tf, code))
        code, tf, place = code[order], tf[order], place[order]
        first = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(tf, prepend=-1) != 0))
        n = len(first) + 1
        places = pa.array(np.concatenate([[0, 0], first[1:], [len(code)]]).astype(np.int32))  # the empty term has none
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, m), pa.int64()), pa.array(np.full(n, block), pa.int32()),
             pa.concat_arrays([pa.array([""], pa.string()), term.dictionary.take(pa.array(code[first]))]),
             pa.array(np.append(0, tf[first]), pa.int32()), pa.ListArray.from_arrays(places, pa.array(place)),
             pa.ListArray.from_arrays(pa.array([0, *[len(ids)] * n], pa.int32()), ids)],
            names=["m", "block", "term", "tf", "members", "docs"])

    def sent(m: int, block: int, held: list):
        # a block has up to about a million postings; as one batch the executor would hold them all beside the worker
        whole = build(m, block, held)
        held.clear()
        for lo in range(0, whole.num_rows, _OUT_ROWS):
            yield whole.slice(lo, _OUT_ROWS)

    def run(batches):
        held, now = [], None
        for batch in batches:
            m, block = batch.column("m").to_numpy(), batch.column("block").to_numpy()
            edges = np.flatnonzero((np.diff(m) != 0) | (np.diff(block) != 0)) + 1
            for lo, hi in zip(np.append(0, edges), np.append(edges, len(m)), strict=True):
                if hi == lo:
                    continue
                if now is not None and now != (m[lo], block[lo]):
                    yield from sent(*now, held)
                now = (m[lo], block[lo])
                part = batch.slice(lo, hi - lo)
                # copied, so that the whole batch is not kept for one row of it
                held.append(tuple(pa.concat_arrays([part.column(c), part.column(c).slice(0, 0)]) for c in ("key", "words", "tfs")))
        if held:
            yield from sent(*now, held)

    return rows.mapInArrow(run, _POSTINGS)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> StratumIndex:
    """Index every row of ``docs``; ids are long, the postings are written as a table."""
    counted = materialize(_counted(docs.withColumn(key, F.col(key).cast("long")).select(key, text), key, text).filter("n > 0"))
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    m = F.lit(100 - _SLOPE) + F.expr(f"({_SLOPE} * n * {total['n']}L) div {max(1, total['l'])}L")
    placed = counted.withColumn("m", m)
    strata = placed.groupBy("m").agg(F.greatest(
        F.ceil(F.sum("n") / _BLOCK_TERMS), F.ceil(F.count(F.lit(1)) / _BLOCK_DOCS)).cast("int").alias("blocks"))
    # distinct lengths add up to L terms at most, so there are under sqrt(2 L) strata: a short list, whatever the table
    dealt = placed.join(F.broadcast(strata), "m").select(
        "m", F.pmod(F.xxhash64("key", "words"), F.col("blocks")).cast("int").alias("block"), "key", "words", "tfs")
    grouped = dealt.repartition("m", "block").sortWithinPartitions("m", "block", F.asc_nulls_last("key"))
    return StratumIndex(materialize(_blocks(grouped)), total["n"], key)


def weight(documents: int, df: Column) -> Column:
    """A term's weight from the documents that hold it."""
    return F.floor(F.lit(float(_WEIGHT)) * F.log(F.lit(2.0 * documents + 2) / (2 * df + 1).cast("double"))).cast("long")


def _impact(tf: str, m: str) -> Column:
    return F.expr(f"({_ONE} * {tf}) div ({_TF} * {tf} + {_M} * {m})")


def _visit(postings: DataFrame, terms: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(row, doc, score): up to ``k`` documents of every block an item visits; ``visits`` is (row, m)."""
    dealt = terms.join(visits, "row")
    asked = dealt.groupBy("m", "chunk", "term").agg(
        F.collect_list("row").alias("rows"), F.collect_list("weight").alias("weights"))
    none = F.array().cast("array<long>")
    heads = dealt.select("m", "chunk").distinct().select("m", "chunk", F.lit("").alias("term"), none.alias("rows"), none.alias("weights"))
    joined = postings.join(asked.unionByName(heads), ["m", "term"]).repartition("m", "block", "chunk").sortWithinPartitions(
        "m", "block", "chunk", "term")

    def best(m: int, docs, held) -> pa.RecordBatch:
        items = np.unique(np.concatenate([h[2] for h in held])) if held else np.zeros(0, np.int64)
        scores = np.zeros((len(items), len(docs)), np.int64)
        for tf, members, rows, weights in held:
            impact = _ONE * tf // (_TF * tf + _M * m)
            scores[np.searchsorted(items, rows)[:, None], members] += (weights * impact)[:, None]  # a document is once in a posting
        found = []
        for row, score in zip(items.tolist(), scores, strict=True):
            least = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else 0
            top = np.flatnonzero(score >= max(1, least))  # places in a block ascend with the ids
            top = top[np.argsort(-score[top], kind="stable")][:k]
            found.append((np.full(len(top), row, np.int64), top, score[top]))
        row, place, score = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3))
        return pa.RecordBatch.from_arrays([pa.array(row), docs.take(pa.array(place)), pa.array(score)], names=["row", "doc", "score"])

    def run(batches):
        docs, held, now = None, [], None
        for batch in batches:
            tf = batch.column("tf").to_pylist()
            values = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("members", "rows", "weights")]
            for i, at in enumerate(zip(*(batch.column(c).to_pylist() for c in ("m", "block", "chunk")), strict=True)):
                if at != now:  # the empty term stands first
                    if now is not None:
                        yield best(now[0], docs, held)
                    docs, held, now = pa.concat_arrays([batch.column("docs")[i].values, pa.array([], pa.int64())]), [], at
                else:
                    held.append([tf[i], *(v[o[i]:o[i + 1]].copy() for o, v in values)])
        if now is not None:
            yield best(now[0], docs, held)

    return joined.mapInArrow(run, "row long, doc long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def search(index: StratumIndex, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 20,
           first: int = 8) -> DataFrame:
    """(key, rank, document key, score): the ``k`` best documents of each row of ``items``, exact."""
    asked = materialize(items.select(F.col(key).alias("item"), F.col(text).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()))
    chunks = max(1, -(-asked.count() // _CHUNK))
    counted = _counted(asked, "row", "text").filter("n > 0").select(
        F.col("key").alias("row"), F.explode(F.arrays_zip(F.split("words", " ").alias("term"), "tfs")).alias("t")).select(
        "row", "t.term", F.col("t.tfs").alias("times"), F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"))
    # the postings of the items' terms, taken out of the index once; the empty terms hold the ids
    names = counted.select("term").distinct().unionByName(asked.sparkSession.range(1).select(F.lit("").alias("term")))
    postings = materialize(index.postings.join(names, "term", "left_semi"))
    df = postings.filter("term <> ''").groupBy("term").agg(F.sum(F.size("members")).alias("df"))
    terms = materialize(counted.join(df.select("term", weight(index.documents, F.col("df")).alias("w")), "term").filter(
        "w <> 0").select("row", "chunk", "term", (F.col("w") * F.col("times")).alias("weight")))
    largest = postings.filter("term <> ''").groupBy("m", "term").agg(F.max(F.col("tf").cast("long")).alias("tf"))
    bounds = largest.join(terms, "term").groupBy("row", "m").agg(F.sum(F.col("weight") * _impact("tf", "m")).alias("bound"))
    order = Window.partitionBy("row").orderBy(F.desc("bound"), "m")
    bounds = materialize(bounds.withColumn("visit", F.row_number().over(order)))
    start = materialize(_ranked(_visit(postings, terms, bounds.filter(F.col("visit") <= first).select("row", "m"), k), k))
    reached = start.filter(F.col("rank") == k).select("row", F.col("score").alias("least"))
    rest = bounds.filter(F.col("visit") > first).join(reached, "row", "left").filter(
        F.col("bound") >= F.coalesce("least", F.lit(1))).select("row", "m")
    found = _ranked(start.select("row", "doc", "score").unionByName(_visit(postings, terms, rest, k)), k)
    return found.join(asked.select("row", "item"), "row").select(
        F.col("item").alias(key), "rank", F.col("doc").alias(index.key), "score")
