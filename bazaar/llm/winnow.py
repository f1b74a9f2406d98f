"""Numpy helpers on byte arrays: window anchors and segment arithmetic."""

from __future__ import annotations

import numpy as np

# An odd multiplier and the constants of a 64-bit finaliser.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Positions hashed at a time, so that the temporaries stay in cache.
SLAB = 1 << 17


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Mixed polynomial hash of every run of ``n`` values (uint64)."""
    out, have = None, 0
    h, width = values + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                # append this power-of-two run behind what has been taken so far
                if out is None:
                    out, have = h, width
                else:
                    tail = h[have:]
                    m = min(len(out), len(tail))
                    out = out[:m] * power(width) + tail[:m]
                    have += width
            if width * 2 > n:
                break
            h = h[:-width] * power(width) + h[width:] if len(h) > width else h[:0]
            width *= 2
        out = out[:max(0, len(values) - n + 1)]
        out = (out ^ (out >> _S29)) * _MIX
        return out ^ (out >> _S32)


def sliding_min(h: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every run of ``window`` values."""
    m, width = h, 1
    while width * 2 <= window:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    rest = window - width
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def window_keys(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The anchor of every window of ``length`` bytes: the least hash of its
    ``gram``-byte runs.  Equal windows have equal anchors."""
    parts, total = [], len(data) - length + 1
    for k in range(0, max(total, 0), SLAB):
        part = data[k:min(k + SLAB, total) + length - 1].astype(np.uint64)
        parts.append(sliding_min(gram_hashes(part, gram), length - gram + 1))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` bytes."""
    total = len(data) - length + 1
    parts = [gram_hashes(data[k:min(k + SLAB, total) + length - 1].astype(np.uint64), length)
             for k in range(0, max(total, 0), SLAB)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every (start, size), one after the other."""
    total = int(sizes.sum())
    offset = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if total else np.zeros(0, np.int64)
    return np.arange(total) + offset


def run_starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
