"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's hash is a
polynomial over a random table of its bytes, taken from prefix sums, so that no word becomes a
Python object. Two different words or shingles share a hash with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_FOLDED = _BYTE[LOWER]
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = {int(b): np.ones(1, dtype=np.uint64) for b in (_BASE, _INVERSE, _STEP)}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept from call to call."""
    known = _powers[int(base)]
    if len(known) < n:
        grown = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        grown[0] = 1
        known = _powers[int(base)] = np.cumprod(grown)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """The words of consecutive texts: hashes and byte places; text i has words first[i]:first[i+1]."""

    lo: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def word_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of a column of texts, about ``limit`` bytes of whole texts at a time; null is empty."""
    for lo, data, offsets in byte_slices(texts, limit):
        yield words_of(lo, data, offsets)


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bytes of consecutive whole texts, about ``limit`` at a time: first row, bytes, places of the texts."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words_of(lo: int, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """The words of the texts; ``space`` tells for each byte whether it separates words."""
    n = len(data)
    inner = np.zeros(n + 1, dtype=bool)
    inner[:n] = ~space[data]
    after = np.zeros(n + 1, dtype=bool)  # whether the byte before is of the same word
    after[1:] = inner[:n]
    after[offsets] = False
    starts = np.flatnonzero(inner & ~after)
    stop = ~inner
    stop[offsets] = True
    stop_at = np.flatnonzero(stop)
    ends = stop_at[np.searchsorted(stop_at, starts, side="right")] if len(starts) else starts
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_FOLDED[data] * _power(_BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts])
    return Words(lo, hashes, starts, ends, np.searchsorted(starts, offsets), offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, whatever text they are of; len(hashes) - k + 1 values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * _STEP + hashes[j : j + n]
    return mix(total)


def long_windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Like ``windows``, at a cost that doesn't grow with k (other values)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _power(_BASE, len(hashes)), out=sums[1:])
    return mix((sums[k:] - sums[:n]) * _power(_INVERSE, n))


def shingles(words: Words, k: int) -> list[np.ndarray]:
    """For each text its distinct k-word shingles, sorted; fewer words than k are one shingle."""
    grams = windows(words.hashes, k)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(mix(windows(words.hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def sequence_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each text two independent hashes of its whole word sequence."""
    n = len(words.hashes)
    out = []
    for values in (words.hashes, mix(words.hashes + np.uint64(0x5851F42D4C957F2D))):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _power(_BASE, n), out=sums[1:])
        first = words.first
        whole = (sums[first[1:]] - sums[first[:-1]]) * _power(_INVERSE, n + 1)[first[:-1]]
        out.append(mix(whole + (first[1:] - first[:-1]).astype(np.uint64)))
    return out[0], out[1]


def lists(values: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit hashes as a column of lists of longs."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
