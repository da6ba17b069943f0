"""Whole texts as flat numpy arrays: words, hashes of runs and content-defined sampling, without a loop over words.

A batch of texts is one byte array with the offset of each text. Hashes are polynomial in 64-bit arithmetic over random
byte values, followed by a finalizer, so equal byte strings have equal hashes anywhere in the corpus.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
SEPARATORS = b" \t\n\x0b\x0c\r"  # the complement of [^\x20\x09-\x0D]


@lru_cache(maxsize=8)
def byte_values(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with `fold`, A-Z have the values of a-z."""
    values = np.random.default_rng(seed).integers(1, 2**64, 256, dtype=U)
    if fold:
        values[65:91] = values[97:123]
    return values


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse for i < n, modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, U(base)), np.full(size, U(pow(base, -1, 1 << 64)))
        up[0] = down[0] = U(1)
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column without nulls, and where each begins (one more offset than texts)."""
    array = column.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if len(array) == 0 or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def range_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int = int(_ODD)) -> np.ndarray:
    """Hash of values[start:stop] for each pair, the length included."""
    up, down = powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(U) * U(0xD1342543DE82EF95))


class Words:
    """The words of a batch: where each begins and ends, its text's number, its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool, seed: int = 1):
        blank = np.zeros(256, bool)
        blank[list(SEPARATORS)] = True
        inside = ~blank[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[firsts] = inside[firsts]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        closes[firsts[1:] - 1] = inside[firsts[1:] - 1]
        if len(data):
            closes[-1] = inside[-1]
        self.start, self.stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        # Word number where each text begins.
        self.first = np.searchsorted(self.start, offsets)
        self.hash = range_hashes(byte_values(seed, fold)[data], self.start, self.stop)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring elements."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, U)
    for j in range(k):
        out = out * _ODD + hashes[j : j + n]
    return mix(out)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of `width` neighbouring values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values
