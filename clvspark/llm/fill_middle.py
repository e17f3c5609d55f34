"""Fill-in-middle transformation by displacement scatter.

Every text is cut into lines at two places drawn from a hash of its key.
A batch of texts is one byte buffer; a rearrangement only displaces runs of
it. So the shift of every byte is written as a difference array (one entry
where a prefix, middle or suffix starts), its cumulative sum gives each
byte's place in the output, and one numpy scatter fills all outputs of the
batch. The inverse reads the sentinels' places off the output, builds the
same shifts and gathers the text back.

The sentinels are unambiguous: texts that contain one stay plain, and as
each starts with ``<`` and ends with ``>``, none can arise across a seam.

Work goes over ``_BLOCK`` bytes at a time whatever the lengths of texts, so
the eight bytes a shift takes are bounded; what is held whole is a group of
texts of about ``_GROUP`` bytes (or one longer text) and its output.

Defined results: a null text is empty; an empty text is plain with no unit;
the draw depends on the key alone, a null key draws like an empty one;
repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The forms by number; ``psm`` writes prefix, suffix, middle, ``spm`` suffix, prefix, middle.
FORMS = ("plain", "psm", "spm")
_MARK = len(PREFIX)
_BLOCK = 1 << 20
_GROUP = 1 << 24


def _scatter(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray) -> None:
    """``out[i + shift of i] = data[i]``; the run from ``starts[r]`` on is shifted by ``shifts[r]``."""
    for lo, hi, shift in _shifted(len(data), starts, shifts):
        out[np.arange(lo, hi) + shift] = data[lo:hi]


def _gather(data: np.ndarray, size: int, starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The inverse: ``data[i + shift of i]`` for i < size."""
    out = np.empty(size, np.uint8)
    for lo, hi, shift in _shifted(size, starts, shifts):
        out[lo:hi] = data[np.arange(lo, hi) + shift]
    return out


def _shifted(size: int, starts: np.ndarray, shifts: np.ndarray):
    """(lo, hi, shift of every byte in lo..hi) by cumulative sums of a difference array, ``_BLOCK`` bytes at a time."""
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for lo in range(0, size, _BLOCK):
        hi = min(size, lo + _BLOCK)
        change = np.zeros(hi - lo, np.int64)
        first, last = np.searchsorted(starts, (lo, hi))
        np.add.at(change, starts[first:last] - lo, steps[first:last])  # empty runs share a start
        shift = np.cumsum(change) + carry
        carry = int(shift[-1])
        yield lo, hi, shift


def _find(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Positions of a sentinel in the buffer."""
    hit = np.flatnonzero(data[:max(0, len(data) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        hit = hit[data[hit + k] == mark[k]]
    return hit


def _within(positions: np.ndarray, offsets: np.ndarray, length: int = _MARK) -> np.ndarray:
    """How many of the (sorted) positions lie in each text, with ``length`` bytes to follow inside it."""
    owner = np.searchsorted(offsets, positions, side="right") - 1
    inside = positions + length <= offsets[owner + 1]
    return np.bincount(owner[inside], minlength=len(offsets) - 1)


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all lines of all texts in order, and the number of lines per text."""
    ends = np.flatnonzero(data == 10) + 1
    filled = offsets[1:][np.diff(offsets) > 0]
    ends = np.union1d(ends, filled)
    return ends, np.diff(np.searchsorted(ends, offsets, side="right"))


def _code_points(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Code points of ``data[lo[i]:hi[i]]``: bytes that do not continue another."""
    edges = np.unique(np.concatenate([lo, hi]))
    edges = edges[edges < len(data)]
    counts = np.add.reduceat((data & 0xC0) != 0x80, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(counts)])
    at = lambda x: before[np.searchsorted(edges, x)]
    return at(hi) - at(lo)


def transform(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, rate: int, spm: int):
    """Outputs of the texts ``data[offsets[i]:offsets[i + 1]]``; ``draws`` (texts, 4) are the hashed numbers.

    Returns (output buffer, its offsets, forms, units, prefix code points, middle code points).
    """
    texts = len(offsets) - 1
    size = np.diff(offsets)
    ends, units = unit_ends(data, offsets)
    marked = sum(_within(_find(data, m), offsets) for m in (PREFIX, SUFFIX, MIDDLE))
    plain = (size == 0) | (marked > 0) | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm, 2, 1))

    first = np.cumsum(units) - units
    def cut(count):  # the byte at which the first ``count`` units of a text end
        return np.where(count == 0, offsets[:-1], ends[np.maximum(first + count - 1, 0)] if len(ends) else offsets[:-1])
    one, two = draws[:, 0] % (units + 1), draws[:, 1] % (units + 1)
    a, b = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    a, b = np.where(plain, offsets[1:], a), np.where(plain, offsets[1:], b)

    out_size = size + np.where(plain, 0, 3 * _MARK)
    out_offsets = np.concatenate([[0], np.cumsum(out_size)])
    base = out_offsets[:-1]
    prefix, middle, suffix = a - offsets[:-1], b - a, offsets[1:] - b
    # where the three runs and the three sentinels of a text go
    to_prefix = base + np.choose(form, [0, _MARK, 2 * _MARK + suffix])
    to_suffix = base + np.choose(form, [0, 2 * _MARK + prefix, _MARK])
    to_middle = base + 3 * _MARK + prefix + suffix
    starts = np.stack([offsets[:-1], a, b], axis=1).ravel()
    shifts = np.stack([to_prefix - offsets[:-1], to_middle - a, to_suffix - b], axis=1).ravel()
    out = np.empty(int(out_offsets[-1]), np.uint8)
    _scatter(data, starts, shifts, out)
    changed = np.flatnonzero(~plain)
    for mark, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k in range(_MARK):
            out[at[changed] - _MARK + k] = mark[k]
    points = _code_points(data, np.concatenate([offsets[:-1], a]), np.concatenate([a, b]))
    return out, out_offsets, form, units, points[:texts], points[texts:]


def restore(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts (buffer, offsets) from outputs and forms alone."""
    size = np.diff(offsets)
    changed = form > 0
    places = []
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = _find(data, mark)
        owner = np.searchsorted(offsets, at, side="right") - 1
        own = (at + _MARK <= offsets[owner + 1]) & changed[owner]
        at, owner = at[own], owner[own]
        place = offsets[:-1].copy()
        place[owner] = at + _MARK
        places.append(place)
    p, s, m = places
    end = offsets[1:]
    prefix = np.choose(form, [size, s - _MARK - p, m - _MARK - p])
    suffix = np.choose(form, [np.zeros_like(size), m - _MARK - s, p - _MARK - s])
    out_size = size - np.where(changed, 3 * _MARK, 0)
    out_offsets = np.concatenate([[0], np.cumsum(out_size)])
    base = out_offsets[:-1]
    at_middle, at_suffix = base + prefix, base + out_size - suffix
    starts = np.stack([base, at_middle, at_suffix], axis=1).ravel()
    shifts = np.stack([p - base, np.where(changed, m, end) - at_middle, np.where(changed, s, end) - at_suffix], axis=1).ravel()
    return _gather(data, int(out_offsets[-1]), starts, shifts), out_offsets


def _buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of an Arrow binary column without nulls."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    return data, offsets.astype(np.int64) - int(offsets[0])


def _column(data: np.ndarray, offsets: np.ndarray):
    """An Arrow binary column of the bytes ``data`` cut at ``offsets``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _groups(batch, column: str):
    """Slices of a batch with about ``_GROUP`` bytes of the column each."""
    _, offsets = _buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _GROUP, side="right")) - 1)
        yield batch.slice(at, until - at)
        at = until


def draws(key: str, salt: str) -> Column:
    """The first four 8-digit groups of the hex sha256 of ``salt:key``, as numbers."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", salt: str = "7", rate: int = 100,
                   spm: int = 50) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of those
    with the suffix first. ``n`` counts lines; the two lengths are code
    points, null for plain texts.
    """
    kept = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
                       draws(key, salt).alias("draws"))
    schema = StructType([kept.schema["key"], StructField("n", LongType()), StructField("form", IntegerType()),
                         StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                         StructField("output", BinaryType())])

    def run(batches):
        for batch in batches:
            for part in _groups(batch, "text"):
                data, offsets = _buffers(part.column("text"))
                drawn = part.column("draws").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                out, places, form, units, prefix, middle = transform(data, offsets, drawn, rate, spm)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(units.astype(np.int64)), pa.array(form.astype(np.int32)),
                     pa.array(prefix, pa.int64(), mask=form == 0), pa.array(middle, pa.int64(), mask=form == 0),
                     _column(out, places)], names=schema.names)

    found = kept.mapInArrow(run, schema)
    return found.select(F.col("key").alias(key), "n", F.get(F.array(*[F.lit(f) for f in FORMS]), F.col("form")).alias("form"),
                        "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``rows`` with the column ``name``: the text rebuilt from output and form alone; a null output gives an empty text."""
    kept = [f"c{i}" for i in range(len(rows.columns))]
    own_output, own_form = kept[rows.columns.index(output)], kept[rows.columns.index(form)]
    number = F.array_position(F.array(*[F.lit(f) for f in FORMS]), F.col(own_form)) - 1
    source = rows.toDF(*kept).select(*kept, F.coalesce(number, F.lit(0)).cast("int").alias("form_number"),
                                     F.coalesce(F.col(own_output), F.lit("")).cast("binary").alias("bytes"))
    schema = StructType([*source.schema.fields[:-2], StructField("restored", BinaryType())])

    def run(batches):
        for batch in batches:
            for part in _groups(batch, "bytes"):
                data, offsets = _buffers(part.column("bytes"))
                back = restore(data, offsets, part.column("form_number").to_numpy().astype(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], _column(*back)], names=schema.names)

    found = source.mapInArrow(run, schema)
    return found.select(*kept, F.col("restored").cast("string")).toDF(*rows.columns, name)
