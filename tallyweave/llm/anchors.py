"""Sampled suffixes: which places of a text stand for all its windows.

Every window of ``width`` values is represented by the place inside it whose run of ``k`` values hashes lowest. Equal windows
have the same place, so whatever repeats over a whole window repeats at a sampled place; neighbouring windows mostly share one.
"""

from __future__ import annotations

import numpy as np

from .words import mixed, powers, run_hashes

PLACE_BITS = 28


def sliding_least(key: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbouring keys."""
    span = 1
    while 2 * span <= w:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    return key if span == w else np.minimum(key[: len(key) - (w - span)], key[w - span :])


def running(values: np.ndarray) -> np.ndarray:
    up, _ = powers(len(values) + 1)
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=run[1:])
    return run


def span_hashes(run: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[begin:end] for a running polynomial."""
    _, down = powers(len(run))
    return mixed((run[end] - run[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sample(values: np.ndarray, text: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(prefix, whole, first, last) of each sampled suffix: hash of its k leading values, hash of all values that its windows cover,
    first and last of those windows by their start. ``text`` numbers the text of each value; windows end with their text."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(values) - width + 1
    if n <= 0:
        return none
    gram, _ = run_hashes(values, k)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((gram & ~mask) | np.arange(len(gram), dtype=np.uint64), width - k + 1)
    starts = np.flatnonzero(text[:n] == text[width - 1 :])
    if not len(starts):
        return none
    place = (least[starts] & mask).astype(np.int64)
    new = np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]
    at = np.flatnonzero(new)
    first, last = starts[at], starts[np.r_[at[1:] - 1, len(starts) - 1]]
    return gram[place[at]], span_hashes(running(values), first, last + width), first, last
