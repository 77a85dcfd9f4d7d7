"""Sorted 64-bit keys and rolling word hashes as compact arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)      # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of their width, compressed: high bytes of small numbers cost nothing."""
    import zstandard

    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as compressed differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint64), dtype=np.uint64)


def by_partition(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, start, stop) of the slices of sorted keys in equal ranges of the 64-bit space."""
    limits = np.array([p * (1 << 64) // parts for p in range(1, parts)], dtype=np.uint64)
    cuts = np.r_[0, np.searchsorted(keys, limits), len(keys)]
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), int(cuts[p]), int(cuts[p + 1])


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _grown(which: int, step: np.uint64, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        size = max(n, 2 * len(_powers[which]))
        powers = np.full(size, step, dtype=np.uint64)
        powers[0] = 1
        _powers[which] = np.multiply.accumulate(powers)
    return _powers[which][:n]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _grown(0, BASE, len(hashes)), out=sums[1:])
    found = (sums[width:] - sums[:-width]) * _grown(1, _INVERSE, n)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))
