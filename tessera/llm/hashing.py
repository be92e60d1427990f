"""Hashes of byte ranges and words for whole Arrow columns at once.

A prefix sum of (random number of the byte) x B^position gives the hash of any range with two look-ups: the difference
of two prefix sums, divided by B^start. All arithmetic is modulo 2^64, where an odd B can be divided by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

B = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(B, -1, 1 << 64)
TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED = TABLE.copy()  # A-Z count as a-z
FOLDED[65:91] = TABLE[97:123]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    """B^i and B^-i for i < n, kept and doubled as needed."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((B, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Prefix:
    """Prefix sums over a buffer of bytes."""

    def __init__(self, data: np.ndarray, table: np.ndarray = TABLE):
        powers, self.inverse = _grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * powers[:len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every range; equal bytes give equal hashes wherever they stand."""
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def text_slices(column: pa.Array, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of at most ``max_bytes`` together; nulls are empty.

    One longer text comes alone.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1)
        yield start, end, data[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start]
        start = end


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of the words; ``separator`` tells for each byte value whether it separates.

    No word reaches over two texts.
    """
    apart = separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~apart
    before = np.empty(len(data), bool)  # the byte before is no part of the same word
    before[:1] = True
    before[1:] = apart[:-1]
    starts = np.flatnonzero(inside & (before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = apart[1:]
    ends = np.flatnonzero(inside & (after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def separators(pattern: str) -> np.ndarray:
    """Table of the ASCII characters that match a regular expression; bytes beyond ASCII never do."""
    import re

    table = np.zeros(256, bool)
    table[:128] = [bool(re.fullmatch(pattern, chr(c))) for c in range(128)]
    return table
