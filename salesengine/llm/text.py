"""Vectorised text primitives on UTF-8 buffers, used inside Arrow batches.

A column of texts is one byte array plus offsets; words, lines and shingles are spans of
it. Blocks bound the memory of the wide intermediate arrays, whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The white space that separates words (space and 0x09 to 0x0D).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 1 << 20
U = np.uint64


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    a = pc.fill_null(col.cast(pa.large_string()), "")
    buffers = a.buffers()
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(buffers[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts [i, j) of about ``limit`` bytes, at least one text each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each text's first word (n + 1 offsets)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    gap = SPACE[data]
    before = np.empty_like(gap)
    before[0], before[1:] = True, gap[:-1]
    after = np.empty_like(gap)
    after[-1], after[:-1] = True, gap[1:]
    before[off[:-1][off[:-1] < len(data)]] = True
    after[off[1:][off[1:] > 0] - 1] = True
    starts = np.flatnonzero(before & ~gap)
    ends = np.flatnonzero(after & ~gap) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, in place (Murmur3's constants, fixed values)."""
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def _odd(seed: int) -> int:
    return int(mix(np.array([seed], np.uint64))[0]) | 5


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
BASE = (_odd(7) & ~2) | 1
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; grown on demand."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * BLOCK_BYTES), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from prefix sums of one polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(BASE, len(data)), out=sums[1:])
    back = powers(pow(BASE, -1, 1 << 64), len(data) + 1)  # an empty span may start at the end
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, woff: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the k-word windows, each window's first word, and each text's first window.

    With ``short``, a text of one to k - 1 words has one window, its whole sequence.
    """
    n = np.diff(woff)
    many = np.maximum(n - k + 1, 0)
    if short:
        many = np.where((n > 0) & (n < k), 1, many)
    off = np.zeros(len(n) + 1, np.int64)
    np.cumsum(many, out=off[1:])
    first = np.repeat(woff[:-1] - off[:-1], many) + np.arange(off[-1])
    left = np.repeat(woff[1:], many) - first
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    out = np.zeros(len(first), np.uint64)
    for j in range(k):
        term = padded[first + j] * U(_odd(100 + j))
        if short:
            term[left <= j] = 0
        out += term
    return mix(out), first, off


def sums_by(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each [off[i], off[i + 1])."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]
