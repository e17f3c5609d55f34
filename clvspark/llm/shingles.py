"""Word shingles of whole texts and their circulant MinHash signatures, in numpy.

A shingle is hashed to 64 bits; sets are compared on those. For signatures
its upper 32 bits are a number x below D = 2**32. Circulant MinHash uses
two permutations of 0..D-1: sigma, then pi shifted circularly::

    signature[k] = min over x of pi((sigma(x) + k) mod D)

Both are bijective integer mixers, so no permutation table is stored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permute32(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A bijection of 32-bit numbers: odd multipliers and shifted exclusive ors, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are maximal runs without ASCII white space, A-Z lower-cased. A
    text with fewer than ``words`` words has its whole sequence as one
    shingle; a text without words has none.
    """
    number: dict[bytes, int] = {}
    ids: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.lower().split()
        sizes[i] = len(found)
        ids += [number.setdefault(w, len(number)) for w in found]
    if not ids:
        return [np.zeros(0, np.uint64)] * len(texts)
    word = np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in number), np.uint64)
    with np.errstate(over="ignore"):
        h = word[np.array(ids)]
        windows = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for k in range(words):
            windows = _mix64(windows * _A + h[k:k + len(windows)] + _B)
        out = []
        ends = np.cumsum(sizes)
        for n, end in zip(sizes, ends, strict=True):
            if n >= words:
                out.append(np.unique(windows[end - n:end - words + 1]))
            elif n:
                one = np.array([n], np.uint64)
                for x in h[end - n:end]:
                    one = _mix64(one * _A + x + _B)
                out.append(one)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], size: int, chunk: int = 1 << 15) -> np.ndarray:
    """(len(sets), size) uint32; all sets must be non-empty. Works on ``chunk`` shingles at a time."""
    out = np.empty((len(sets), size), np.uint32)
    at = 0
    while at < len(sets):
        until, total = at, 0
        while until < len(sets) and (until == at or total + len(sets[until]) <= chunk):
            total += len(sets[until])
            until += 1
        part = sets[at:until]
        starts = np.cumsum([0, *map(len, part[:-1])])
        x = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        x = _permute32(x, 0x7FEB352D, 0x846CA68B)  # sigma
        for k in range(size):
            shifted = _permute32(x + np.uint32(k), 0x21F0AAAD, 0xD35A2D97)  # pi, shifted by k
            out[at:until, k] = np.minimum.reduceat(shifted, starts)
        at = until
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) int64: one hash per band, with the band's number in it."""
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _B, (len(signature), 1))
        parts = signature[:, :bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
        for r in range(rows):
            key = _mix64(key * _A + parts[:, :, r])
    return key.view(np.int64)


def intersection(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
