"""Words and word n-grams of texts as 64-bit hashes, by numpy over UTF-8 bytes.

Words are maximal runs of bytes other than space and \\t-\\r (characters past
ASCII are words' characters). Two different words get the same hash with a chance
of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SOLID = np.ones(256, dtype=bool)
_SOLID[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and the n + 1 word offsets of the
    n texts that lie end to end in ``raw``."""
    size = len(raw)
    solid = _SOLID[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    first[cuts] = solid[cuts]  # a word ends where its text ends
    last[cuts - 1] = solid[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    if not len(starts):
        return np.empty(0, np.uint64), starts, starts, np.zeros(len(offsets), np.int64)
    place = np.arange(size, dtype=np.int32)
    place -= np.maximum.accumulate(np.where(first, place, np.int32(0)))
    value = _BYTE[_LOWER[raw] if lower else raw]
    value *= _PLACE[place & np.int32(len(_PLACE) - 1)]
    far = np.flatnonzero(place >= len(_PLACE))  # a word's hash must not depend on its neighbours
    if len(far):
        value[far] = mixed(value[far] + (place[far] // len(_PLACE)).astype(np.uint64))
    value *= solid
    h = mixed(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64) * _GRAM[63])
    return h, starts, ends, np.searchsorted(starts, offsets)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, one for each start."""
    count = len(h) - n + 1
    out = h[:count] * _GRAM[0]
    for k in range(1, n):
        out = out + h[k:k + count] * _GRAM[k % 63] * np.uint64(2 * (k // 63) + 1)
    return mixed(out)


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text is one shingle as a whole."""
    if len(h) >= n:
        return distinct(grams(h, n))
    return grams(h, len(h)) ^ np.uint64(len(h)) if len(h) else h


def set_hash(s: np.ndarray, salt: int) -> int:
    """64-bit hash of a set of hashes, as a signed number."""
    total = np.add.reduce(mixed(s ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))), dtype=np.uint64)
    return int(mixed(np.array([total ^ np.uint64(len(s))], dtype=np.uint64)).view(np.int64)[0])
