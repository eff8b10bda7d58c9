"""Vectorised hashing of bytes and words over Arrow text, shared by the text operators.

A whole slice of documents is hashed at once. Strings get polynomial hashes modulo
2**64 over a random value per byte; prefix sums give the hash of any substring in
constant time. Nothing here depends on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
#: The same with A-Z folded to a-z.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
_powers = (np.ones(1, U), np.ones(1, U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        _powers = tuple(np.cumprod(np.concatenate([np.ones(1, U), np.full(size, b, U)]), dtype=U)
                        for b in (_BASE, _UNBASE))
    return _powers


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values whose output bits look independent of the input."""
    x = x ^ U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes (one row at least): first row, row after the last,
    their UTF-8 bytes, and the offsets of each row in them. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


class Prefix:
    """Hashes of substrings of one string, given a 64-bit value for each of its symbols."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        base, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * base[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unmixed hashes of [start, end)."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def grams(self, k: int) -> np.ndarray:
        """Unmixed hashes of every run of k symbols."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, U)
        return (self.sums[k:] - self.sums[: n - k + 1]) * self.inverse[: n - k + 1]


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) over every run of ``width`` values."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[: -(width - have)], x[width - have :]) if have < width else x


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without space or 0x09 to 0x0D) of a slice: byte starts, byte ends, row, and
    64-bit hash with A-Z folded to lower case. Words never cross rows."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, U)
    inside = ~_SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    hashes = mix(Prefix(FOLDED_VALUES[data]).of(starts, ends) + (ends - starts).astype(U))
    return starts, ends, rows, hashes


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of words of each row of a slice."""
    inside = np.append(~_SEPARATOR[data], False)
    starts = inside & ~np.concatenate([[False], inside[:-1]])
    starts[offsets] = inside[offsets]
    sums = np.concatenate([[0], np.cumsum(starts)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


_GRAM = np.random.default_rng(7).integers(1, 1 << 62, 64).astype(U) * U(2) + U(1)


def shingles(rows: np.ndarray, hashes: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words of a row, in order, and the bounds of each row in them.

    A row of fewer words (but any) has one: its whole sequence.
    """
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    lengths = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    if not n:
        return np.zeros(0, U), bounds
    padded = np.concatenate([hashes, np.zeros(size, U)])
    grams = padded[:n] * _GRAM[0]
    for j in range(1, size):
        grams += padded[j : n + j] * _GRAM[j]
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[:-1], lengths)
    out = grams[at]
    for r in short:
        a, b = first[r], first[r + 1]
        out[bounds[r] : bounds[r] + 1] = (hashes[a:b] * _GRAM[: b - a]).sum(dtype=U, keepdims=True) + U(b - a)
    return mix(out), bounds
