"""Words of many texts at once: bounds, hashes, runs. Arrays over a block of texts laid end to end."""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Odd factors of the rolling hashes and their final mixing; any odd numbers do.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: A random 64-bit value for each byte.
VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never runs on into the next text."""
    if not len(raw):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    ink = ~BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before, after = np.r_[False, ink[:-1]], np.r_[ink[1:], False]
    start = np.flatnonzero(ink & (~before | edge[:-1]))
    end = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * BASE
    return h ^ (h >> np.uint64(32))


_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("_powers", BASE), ("_inverse", back)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            globals()[name] = np.multiply.accumulate(p)
    return _powers[:n], _inverse[:n]


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each word, by differences of a running polynomial."""
    up, down = powers(len(raw) + 1)
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(VALUE[raw] * up[:-1], out=run[1:])
    return mixed((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def run_hashes(values: np.ndarray, width: int, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive values, and where they start; with doc, only runs within one text."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = powers(len(values) + 1)
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=run[1:])
    h = mixed((run[width:] - run[:-width]) * down[:n] + np.uint64(width))
    at = np.arange(n)
    if doc is not None:
        at = at[doc[:n] == doc[width - 1 :]]
        h = h[at]
    return h, at
