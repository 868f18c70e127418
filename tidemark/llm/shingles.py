"""Words and word shingles as 64-bit hashes, computed for many texts at a time."""

from __future__ import annotations

from functools import cache

import numpy as np

U64 = np.uint64
# Fixed odd multipliers of the finaliser and of the places of a shingle.
MIX_1, MIX_2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
SHIFT = U64(33)
BASE = 0x9E3779B97F4A7C15
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MIX_1
    x = (x ^ (x >> SHIFT)) * MIX_2
    return x ^ (x >> SHIFT)


@cache
def byte_values(fold: bool) -> np.ndarray:
    """A random value per byte; white space is 0, and with ``fold`` A-Z have the values of a-z."""
    values = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
    if fold:
        values[65:91] = values[97:123]
    values[list(SPACES)] = 0
    return values


# Bytes of text that powers are kept for, the first that suffice; those for a longer text are made for it and dropped.
KEPT_POWERS = (1 << 18, 1 << 20)


def _made(n: int) -> tuple[np.ndarray, np.ndarray]:
    bases = [np.full(n, U64(b), U64) for b in (BASE, pow(BASE, -1, 1 << 64))]
    for b in bases:
        b[0] = 1
        np.cumprod(b, dtype=U64, out=b)
    return bases[0], bases[1]


_kept_powers = cache(_made)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    kept = next((k for k in KEPT_POWERS if n <= k), None)
    return _made(n) if kept is None else _kept_powers(kept)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts that lie end to end: hash, first byte, byte after the last, and the number of words before each text.

    A word is a run of bytes other than white space (0x20, 0x09 to 0x0D); it ends where its text ends. The hash is a polynomial
    in the word's bytes modulo 2**64, taken from running sums, so it costs the same for words of any length.
    """
    n = len(data)
    if n == 0:
        nothing = np.zeros(0, np.int64)
        return np.zeros(0, U64), nothing, nothing, np.zeros(len(offsets), np.int64)
    values = byte_values(fold)[data]
    inside = values != 0
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words, in order; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    size_here = min(n, size)
    total = np.full(n - size_here + 1, size_here, U64)
    for place in range(size_here):
        total = total * MIX_1 + words[place : n - size_here + 1 + place]
        total ^= total >> SHIFT
    return mixed(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in the order of their hashes."""
    return np.unique(shingles_of(words, size))
