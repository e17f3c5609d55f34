"""Byte-level helpers of the passage operator, in numpy: anchors, runs and longest previous factors."""

from __future__ import annotations

import numpy as np

_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POSITION = 20  # bits for a position within a chunk


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash bases and their inverses modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = None

    def get(self, n: int):
        if self.up is None or self.up.shape[1] < n:
            n = max(n, 1 << 16)
            up, down = np.empty((2, n), np.uint64), np.empty((2, n), np.uint64)
            for i, base in enumerate(_BASES):
                for out, b in ((up, base), (down, pow(base, -1, 1 << 64))):
                    out[i] = b
                    out[i, 0] = 1
                    np.cumprod(out[i], out=out[i])
            self.up, self.down = up, down
        return self.up, self.down


def runs(data: np.ndarray, width: int, gram: int, powers: Powers, chunk: int = 1 << 18):
    """(anchor hash, span hash, first window, last window) of a text's runs of windows.

    Each window of ``width`` bytes picks the ``gram``-byte string in it with
    the smallest hash (the leftmost of equals), which depends on its content
    only. A run is a stretch of windows that pick the same place; its span
    is all their bytes. Long texts go in chunks, each with all its windows.
    """
    parts = []
    windows = len(data) - width + 1
    for at in range(0, max(0, windows), chunk):
        piece = data[at:at + chunk + width - 1]
        parts.append(_runs(piece, width, gram, powers) + np.array([[0], [0], [at], [at]], np.int64).view(np.uint64))
    return np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.uint64)


def _runs(data: np.ndarray, width: int, gram: int, powers: Powers) -> np.ndarray:
    n = len(data)
    up, down = powers.get(n + 1)
    value = data.astype(np.uint64) + np.uint64(1)
    prefix = np.zeros((2, n + 1), np.uint64)
    np.cumsum(value * up[0, :n], out=prefix[0, 1:])
    np.cumsum(value * up[1, :n], out=prefix[1, 1:])
    grams = n - gram + 1
    h = _mix((prefix[0, gram:] - prefix[0, :grams]) * down[0, :grams])
    low = np.uint64((1 << _POSITION) - 1)
    packed = (h & ~low) | np.arange(grams, dtype=np.uint64)
    span = width - gram + 1                       # grams in a window
    windows = n - width + 1
    # minima over sliding windows from running minima of blocks, forwards and backwards
    size = -(-grams // span) * span
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:grams] = packed
    blocks = padded.reshape(-1, span)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    chosen = np.minimum(backward[:windows], forward[span - 1:span - 1 + windows])
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [windows]]) - 1
    place = (chosen[first] & low).astype(np.int64)
    whole = _mix((prefix[1, last + width] - prefix[1, first]) * down[1, first]
                 + (last - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    # the place of the anchor within the span is part of what must agree
    whole ^= _mix((place - first).astype(np.uint64) + np.uint64(1))
    return np.stack([h[place], whole, first.astype(np.uint64), last.astype(np.uint64)])


def window_hashes(data: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """(2, windows) hashes of all windows of a span."""
    n = len(data)
    up, down = powers.get(n + 1)
    value = data.astype(np.uint64) + np.uint64(1)
    out = []
    for i in (0, 1):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * up[i, :n])])
        out.append(_mix((prefix[width:] - prefix[:n - width + 1]) * down[i, :n - width + 1]))
    return np.stack(out)


def suffix_classes(text: np.ndarray, width: int) -> np.ndarray:
    """Rank of every suffix in the order of their first ``width`` bytes; equal ranks, equal bytes.

    Suffix order by prefix doubling, cut at ``width``. ``text`` is uint16;
    positions past the end sort first.
    """
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, known = rank.astype(np.int64) + 1, 1
    while known < width:
        step = min(known, width - known)
        later = np.zeros(n, np.int64)
        later[:n - step] = rank[step:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + later, return_inverse=True)
        rank, known = rank.astype(np.int64) + 1, known + step
    return rank


def previous_factors(spans: list[bytes], width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each span and each of its windows: is there an equal one earlier, and is there one anywhere else?

    The spans are laid out in order and their suffixes sorted by their first
    ``width`` bytes. In that order the longest previous factor of a suffix
    is shared with the nearest smaller position before or after it. Cut at
    ``width``, the two lie in the suffix's own class if at all: it reaches
    ``width`` exactly if its class holds a smaller position.
    """
    sizes = np.array([len(s) for s in spans])
    text = np.zeros(int(sizes.sum()) + len(spans), np.uint16)
    begins = np.cumsum(sizes + 1) - sizes - 1
    for at, s in zip(begins, spans, strict=True):  # a zero ends each span
        text[at:at + len(s)] = np.frombuffer(s, np.uint8).astype(np.uint16) + 1
    counts = sizes - width + 1
    positions = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    rank = suffix_classes(text, width)[positions]
    order = np.argsort(rank, kind="stable")       # suffix order, equal ones by position
    ranked = rank[order]
    same = ranked[1:] == ranked[:-1]
    earlier, other = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = same
    other[order[1:]] = same
    other[order[:-1]] |= same
    cuts = np.cumsum(counts)[:-1]
    return np.split(earlier, cuts), np.split(other, cuts)


def stretches(hits: np.ndarray, start: int, width: int) -> list[tuple[int, int]]:
    """Byte intervals covered by the windows that ``hits`` marks, the first window at ``start``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return [(start + int(a), start + int(b) - 1 + width) for a, b in edge.reshape(-1, 2)]


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal intervals; touching ones join."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
