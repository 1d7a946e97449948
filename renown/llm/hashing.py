"""Hashes of words and byte ranges of many texts at once.

Texts are laid end to end in one byte buffer, and byte ranges of it are hashed without building
their strings. Where every place of a text needs the hash of its next bytes, a polynomial
prefix hash modulo 2**64 gives each from two look-ups; such hashes may agree for different
ranges, so they only choose places and buckets.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@functools.lru_cache(4)
def _powers(size: int, base: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for buffers of up to n bytes."""
    size = 1 << max(16, (n + 1).bit_length())
    return _powers(size, _BASE), _powers(size, pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LONG = 256


def byte_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end (exclusive), for many ranges.

    Short ranges are chained through ``mix`` eight bytes at a time, long ones go through BLAKE2b, so no
    structure of the text makes different ranges agree.
    """
    size = end - start
    value = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    view = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    open_, step = np.flatnonzero((size > 0) & (size <= _LONG)), 0
    while len(open_):
        left = np.minimum(size[open_] - step, 8).astype(np.uint64)
        block = view[start[open_] + step] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
        value[open_] = mix((value[open_] ^ block) + np.uint64(0xD6E8FEB86659FD93))
        step += 8
        open_ = open_[size[open_] > step]
    for k in np.flatnonzero(size > _LONG).tolist():
        digest = hashlib.blake2b(raw[start[k] : end[k]].tobytes(), digest_size=8).digest()
        value[k] = int.from_bytes(digest, "little")
    return value


class Buffer:
    """Texts end to end, one newline after each."""

    def __init__(self, texts: list[bytes], lower: bool = False) -> None:
        joined = b"\n".join([*texts, b""])
        self.bytes = joined
        raw = np.frombuffer(joined, np.uint8)
        self.raw = LOWER[raw] if lower else raw
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[: len(texts)]
        self.ends = self.starts + lengths

    @functools.cached_property
    def prefix(self) -> np.ndarray:
        n = len(self.raw)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * powers(n)[0][:n], out=sums[1:])
        return sums

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes start..end (exclusive), for many ranges."""
        return byte_hashes(self.raw, start, end)

    def rolling(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A weak hash of many overlapping ranges; equal ranges agree, some different ones do too."""
        return mix((self.prefix[end] - self.prefix[start]) * powers(len(self.raw))[1][start])

    def words(self, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every word; words are runs of bytes outside ``gaps``."""
        inside = np.concatenate([[False], ~gaps[self.raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        return start, end, np.searchsorted(self.starts, start, side="right") - 1
