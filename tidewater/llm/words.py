"""Word and shingle hashes of Arrow text buffers, a batch of texts at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Each gets a 64-bit
hash: the sum of a random value per byte times a power of an odd multiplier,
modulo 2**64, taken from running sums so that no Python loop sees a word.
"""

from __future__ import annotations

import functools

import numpy as np

BLOCK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit hangs on all input bits."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(2)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


@functools.lru_cache(1)
def _is_word() -> np.ndarray:
    out = np.ones(256, bool)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return out


@functools.lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return _power_table(BLOCK + 1)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, np.uint64), np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte start and end of every word; ``offsets`` are the rows' bounds in ``data``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = _is_word()[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of data[start:end] for each of the spans, which ascend and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    values = _byte_values(lower)
    i = 0
    while i < len(starts):  # whole spans, up to BLOCK bytes at a time
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        size = int(ends[j - 1] - base)
        up, down = _powers() if size <= BLOCK else _power_table(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base : base + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    # a span's length enters too, so that no run of one byte equals another
    return mix(out ^ ((ends - starts).astype(np.uint64) * _Q))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every row)."""
    starts, ends = spans(data, offsets)
    return span_hashes(data, starts, ends, lower), np.diff(np.searchsorted(starts, offsets, "left"))


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of each run of ``size`` words inside one row."""
    n = len(hashes) - size + 1
    rows = np.repeat(np.arange(len(counts)), counts)
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc = acc * _Q + hashes[k : k + n]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mix(acc[at] + np.uint64(size)), rows[at], at


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words is one shingle, an empty one none."""
    keys, rows, _ = windows(hashes, counts, size)
    bounds = np.searchsorted(rows, np.arange(len(counts) + 1))
    firsts = np.concatenate(([0], np.cumsum(counts)))
    out = []
    for r, n in enumerate(counts):
        if n >= size:
            out.append(np.unique(keys[bounds[r] : bounds[r + 1]]))
        elif n:
            out.append(windows(hashes[firsts[r] : firsts[r + 1]], np.array([n]), int(n))[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out
