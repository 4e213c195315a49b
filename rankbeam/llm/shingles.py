"""Distinct word-shingle sets of whole texts as sorted 64-bit hashes.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased. All
documents of an Arrow slice are hashed together on their UTF-8 bytes; no
Python string is made. A text with fewer words than the shingle width gives
its whole word sequence as one shingle; a null text or one without words gives
an empty set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import text_buffers

_U = np.uint64
# Odd multipliers of the 64-bit mixing steps.
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_M1 = _U(0xBF58476D1CE4E5B9)
_M2 = _U(0x94D049BB133111EB)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _M1
    x = x ^ (x >> _U(27))
    x = x * _M2
    return x ^ (x >> _U(31))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for k, b in enumerate((_BASE, inverse)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray, off: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its document) in text order; ``fold`` lower-cases A-Z."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[raw] if fold else raw
    word = ~_SPACE[low]
    edge = np.zeros(n, bool)  # first byte of each document
    starts_at = off[:-1][off[:-1] < n]
    edge[starts_at] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _power_tables(n)
    with np.errstate(over="ignore"):
        sums = np.cumsum((low.astype(np.uint64) + _U(1)) * up[:n])
        h = sums[b] - np.where(a > 0, sums[a - 1], _U(0))
        h = mix(h * down[a] + (b - a + 1).astype(np.uint64) * _M2)
    return h, np.searchsorted(off, a, "right") - 1


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from every position; positions with fewer words left are absent."""
    out = np.zeros(max(0, len(h) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        by = mix(np.arange(1, width + 1, dtype=np.uint64) * _BASE + _U(seed) * _M2) | _U(1)
        for k in range(width):
            out += h[k:k + len(out)] * by[k]
        return mix(out)


def shingle_sets(col: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    raw, off, _ = text_buffers(col)
    h, doc = word_hashes(raw, off)
    counts = np.bincount(doc, minlength=len(col)) if len(doc) else np.zeros(len(col), np.int64)
    ends = np.cumsum(counts)
    multipliers = mix(np.arange(1, width + 1, dtype=np.uint64) * _BASE) | _U(1)
    empty = np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, len(h) - width + 1), np.uint64)
        for k in range(width):
            whole += h[k:k + len(whole)] * multipliers[k]
        whole = mix(whole)
        out = []
        for e, c in zip(ends.tolist(), counts.tolist(), strict=True):
            if c >= width:
                out.append(np.unique(whole[e - c:e - width + 1]))
            elif c:
                some = (h[e - c:e] * multipliers[:c]).sum(dtype=np.uint64)
                out.append(mix(np.array([some + _U(c) * _M1], np.uint64)))
            else:
                out.append(empty)
    return out
