"""Quality rules: cross-document line frequency per host, and counts within each text.

A line is normalised (trimmed, white space runs to one blank, lower-cased)
and hashed. Lines that occur in more than ``max_documents`` documents of one
host, and in more than ``max_share`` of its documents, are boilerplate there.
A document's depletion is the share of its word characters in such lines;
it is rejected when too little is left, or when it fails the base rules.

Counts go through partial aggregation before each shuffle; what is joined
back is one row per document and host line, 8-byte hashes only. Hosts and
lines may be as frequent as they like: the frequent lines are joined by
(host, line) with a salt, so that one line's documents spread over tasks.

Defined results: null and empty texts have no words and fail the base
rules; repeated rows get equal results, and equal texts of a host count as one
document there; a null host is a host of its own. Other columns are ignored.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.session import materialize

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_WINDOW = 8
_SCHEMA = ("key long, host string, digest long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, lines array<long>, line_chars array<long>")


def _hash(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def repeated_words(words: list[bytes], window: int = _WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    # ranks of longer and longer windows, doubled until the full width: exact, without hashing
    rank, width = ids, 1
    while width < window:
        m = len(words) - 2 * width + 1
        _, rank = np.unique(rank[:m] * (int(rank.max()) + 1) + rank[width:width + m], return_inverse=True)
        width *= 2
    counts = np.bincount(rank)
    starts = np.flatnonzero(counts[rank] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measures(text: bytes) -> tuple[int, int, int, int, int, dict[int, int]]:
    """The base counts of a text, and its normalised lines' hashes with the characters in their words."""
    words = text.split()
    solid = sum(map(len, words))
    # code points: bytes that do not continue another
    data = np.frombuffer(text, np.uint8)
    chars = int(((data & 0xC0) != 0x80).sum()) - (len(data) - solid)
    lines: dict[int, int] = {}
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        at = _hash(b" ".join(parts).lower())
        lines[at] = lines.get(at, 0) + len(b"".join(parts).decode(errors="replace"))
    return len(words), chars, len(_SYMBOLS.findall(text)), repeats, repeated_words(words), lines


def line_table(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Per row: base counts, distinct line hashes and the word characters in each line."""

    def run(batches):
        for batch in batches:
            rows = [measures(t) for t in batch.column("text").to_pylist()]
            digest = [_hash(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("host"), pa.array(digest, pa.int64()),
                 *[pa.array([r[k] for r in rows], pa.int64()) for k in range(5)],
                 pa.array([list(r[5]) for r in rows], pa.list_(pa.int64())),
                 pa.array([list(r[5].values()) for r in rows], pa.list_(pa.int64()))],
                names=["key", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "lines", "line_chars"])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col(host).cast("string").alias("host"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    return source.mapInArrow(run, _SCHEMA)


def frequent_lines(table: DataFrame, max_documents: int, max_share: float) -> DataFrame:
    """(host, line) of the lines above both limits; equal texts of a host count once, so copies make no boilerplate."""
    one = table.groupBy("digest", "host").agg(F.first("lines").alias("lines"))
    sizes = one.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    counted = one.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_documents)
    return counted.alias("c").join(sizes.alias("s"), F.expr("c.host <=> s.host")).filter(
        F.col("n") > max_share * F.col("documents")).select("c.host", "line")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", max_documents: int = 10,
          max_share: float = 0.01, max_depletion: float = 0.8, min_words: int = 20, max_repeat: int = 30,
          salts: int = 16) -> DataFrame:
    """The base counts, base_failed, boilerplate_chars and kept of every row.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat`` percent of them in repeated windows. ``kept`` is false
    then, and when more than ``max_depletion`` of the word characters lie in
    frequent lines.
    """
    rows = materialize(line_table(docs, key, text, host))
    frequent = materialize(frequent_lines(rows, max_documents, max_share)).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    exploded = rows.select("key", "digest", "host", F.posexplode("lines").alias("at", "line"), "line_chars").select(
        "key", "digest", "host", "line", F.get("line_chars", F.col("at")).alias("chars"),
        F.pmod(F.xxhash64("key", "digest"), F.lit(salts)).cast("int").alias("salt")).distinct()
    hit = exploded.alias("x").join(frequent.alias("f"), F.expr("x.line = f.line AND x.salt = f.salt AND x.host <=> f.host"))
    removed = hit.groupBy("x.key", "x.digest", "x.host").agg(F.sum("x.chars").alias("boilerplate_chars"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    gone = F.coalesce(F.col("boilerplate_chars"), F.lit(0)).cast("long")
    return rows.drop("lines", "line_chars").alias("r").join(
        removed.withColumnsRenamed({"key": "k", "digest": "d", "host": "h"}),
        F.expr("r.key <=> k AND r.digest = d AND r.host <=> h"), "left").select(
        F.col("r.key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), gone.alias("boilerplate_chars"),
        (~failed & (gone <= max_depletion * F.col("word_chars"))).alias("kept"))


def without_frequent_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
                           max_documents: int = 10, max_share: float = 0.01) -> DataFrame:
    """(key, text): every row's text without its host's frequent lines; null texts become empty."""
    rows = materialize(line_table(docs, key, text, host))
    frequent = materialize(frequent_lines(rows, max_documents, max_share))
    drop = rows.select("key", "digest", "host", F.explode("lines").alias("line")).alias("x").join(
        frequent.alias("f"), F.expr("x.line = f.line AND x.host <=> f.host")).groupBy("x.key", "x.digest", "x.host").agg(
        F.collect_set("x.line").alias("gone"))

    def strip(batches):
        for batch in batches:
            texts = []
            for t, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                gone = set(gone or [])
                texts.append(b"\n".join(x for x in t.split(b"\n")
                                        if not gone or _hash(b" ".join(x.split()).lower()) not in gone).decode())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], names=["key", "text"])

    def digests(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_hash(t) for t in batch.column("text").to_pylist()], pa.int64())],
                names=["key", "host", "text", "digest"])

    source = docs.select(F.col(key).cast("long").alias("key"), F.col(host).cast("string").alias("host"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    marked = source.mapInArrow(digests, "key long, host string, text binary, digest long").alias("r").join(
        drop.withColumnsRenamed({"key": "k", "digest": "d", "host": "h"}),
        F.expr("r.key <=> k AND r.digest = d AND r.host <=> h"), "left").select("r.key", "r.text", "gone")
    return marked.mapInArrow(strip, "key long, text string").toDF(key, text)
