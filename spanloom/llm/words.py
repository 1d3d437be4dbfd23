"""Words and word windows of many texts at once, as 64-bit fingerprints in numpy.

A word is a maximal run of bytes outside ``20 09-0D``. Its fingerprint is a polynomial over per-byte random
numbers modulo 2^64, taken from running sums, then mixed; a window's is the same over its words' fingerprints. Such
polynomials meet themselves on some long patterns (two letters in the order of Thue and Morse), so a range of more
than ``SUMMED`` bytes has a hash of its bytes in its place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .common import text_buffer, worker_state

U64 = np.uint64
_BYTE_BASE, _BYTE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_WORD_BASE, _WORD_INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_SECOND_BASE, _SECOND_INVERSE = 0xA0761D6478BD642F, pow(0xA0761D6478BD642F, -1, 1 << 64)
#: Longer ranges of bytes are hashed one by one.
SUMMED = 64
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _tables() -> dict:
    numbers = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return {"numbers": numbers, "lowered": numbers[lower], "space": space, "lower": lower}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power 0..n-1 modulo 2^64; kept for the next call."""
    kept = worker_state("powers", dict)
    if base not in kept or len(kept[base]) < n:
        filled = np.full(1 << max(10, (n - 1).bit_length()), base, U64)
        filled[0] = 1
        kept[base] = np.multiply.accumulate(filled)
    return kept[base][:n]


class Words:
    """The words of a text column: ``doc`` (row), ``start`` and ``end`` (bytes), ``code`` (fingerprint), ``first`` (word range of each row)."""

    def __init__(self, column: pa.Array, lower: bool = False):
        tables = worker_state("word_tables", _tables)
        self.data, self.bounds = text_buffer(column)
        self.lower = lower
        n = len(self.data)
        black = ~tables["space"][self.data]
        edge = np.zeros(n + 1, bool)  # a row begins here
        edge[self.bounds] = True
        begins = black.copy()
        begins[1:] &= ~black[:-1] | edge[1:n]
        ends = black.copy()
        ends[:-1] &= ~black[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self._sums = np.zeros(n + 1, U64)
        np.cumsum(tables["lowered" if lower else "numbers"][self.data] * powers(_BYTE_BASE, n), out=self._sums[1:])
        self.code = self.range_codes(self.start, self.end)
        self.first = np.searchsorted(self.start, self.bounds)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def range_codes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The fingerprints of byte ranges."""
        codes = mix((self._sums[end] - self._sums[start]) * powers(_BYTE_INVERSE, len(self.data) + 1)[start])
        long = np.flatnonzero(end - start > SUMMED)
        if len(long):
            lower = worker_state("word_tables", _tables)["lower"]
            for i, a, b in zip(long.tolist(), start[long].tolist(), end[long].tolist(), strict=True):
                codes[i] = xxhash.xxh3_64_intdigest((lower[self.data[a:b]] if self.lower else self.data[a:b]).tobytes())
        return codes

    def windows(self, size: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``(at, code)``: the word at which each window of ``size`` words begins, and the window's fingerprint."""
        n = len(self.start)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        base, inverse = (_SECOND_BASE, _SECOND_INVERSE) if second else (_WORD_BASE, _WORD_INVERSE)
        sums = np.zeros(n + 1, U64)
        np.cumsum(self.code * powers(base, n), out=sums[1:])
        at = np.flatnonzero(self.doc[: n - size + 1] == self.doc[size - 1 :])
        return at, mix((sums[at + size] - sums[at]) * powers(inverse, n)[at])
