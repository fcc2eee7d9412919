"""Hashes of words and of word runs, computed for a whole text at once."""

from __future__ import annotations

import numpy as np

#: The white space of the contracts here: space and the control characters 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_upto(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(2 * n, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def word_spans(data: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are no ``spaces``."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(spaces[data], out=inside[1:-1], casting="unsafe")
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans do not overlap and lie in order."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    taken = data[place + np.repeat(starts, lengths)]
    parts = (taken.astype(np.uint64) + np.uint64(1)) * _powers_upto(int(lengths.max()))[place]
    return mix64(np.add.reduceat(parts, first) + lengths.astype(np.uint64))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; fewer words, but not none, make one run."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out = mix64(out * _BASE + words[k : n - size + 1 + k])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, A-Z lower-cased."""
    data = LOWER[as_bytes(text)]
    return np.unique(run_hashes(span_hashes(data, *word_spans(data)), size))
