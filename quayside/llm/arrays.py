"""Texts as numpy arrays: views of Arrow strings, rolling hashes, word bounds.

Everything here works inside one task on one batch.  A batch is cut into groups of whole texts of
about ``GROUP_BYTES`` so that temporary arrays stay small; a longer text is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

#: one random code per byte value, so that hashes depend on no arithmetic of byte values
CODES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
CODES_2 = np.random.Generator(np.random.PCG64(20240608)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, GROUP_BYTES + 1024)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


class Rolling:
    """Hashes of any span of a byte array in constant time: prefix sums of code times power."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = CODES):
        self._sum(codes[data])

    @classmethod
    def over(cls, values: np.ndarray) -> Rolling:
        """The same for a row of 64-bit values, such as hashes of words."""
        self = cls.__new__(cls)
        self._sum(values)
        return self

    def _sum(self, values: np.ndarray) -> None:
        n = len(values)
        up, self.down = _power_tables(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], dtype=np.uint64, out=self.prefix[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each [start, end), its length included."""
        raw = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * _M2)

    def windows(self, width: int) -> np.ndarray:
        """Hash of the window at each offset (all of one width)."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self.prefix[width:] - self.prefix[:n]) * self.down[:n]
        return mix(raw + np.full(1, width, np.uint64) * _M2)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each text starts (one more offset than rows).

    A null counts as an empty text.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data, offsets


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of rows whose texts have about ``limit`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, i + 4096, n)
        yield i, j
        i = j


def word_bytes(separators: bytes) -> np.ndarray:
    """Table by byte value: is it part of a word?"""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: words of letters and digits: all but ASCII punctuation, blanks and controls
WORDS = word_bytes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: words between blanks
BLANKS = word_bytes(b"\x20\x09\x0a\x0b\x0c\x0d")

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some texts, and the first word of each text (one more than texts).

    ``data`` holds the texts one after another, ``offsets`` count from its start.  A-Z are taken
    as a-z.  Words end at the end of their text.
    """
    lower = LOWER[data]
    inside = table[lower]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Rolling(lower).spans(starts, ends), np.searchsorted(starts, offsets)


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of some texts start and end, and the first word of each text (one more than texts).

    As in ``words_of``, but bytes count as they are.
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    step = np.diff(inside)
    first, last = step > 0, step < 0
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    through = edges[(inside[edges] > 0) & (inside[edges + 1] > 0)]  # words that touch across two texts
    first[through] = last[through] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """Hash of each word; a long text is hashed a part at a time, so that memory follows its words."""
    out, k = np.zeros(len(starts), np.uint64), 0
    while k < len(starts):
        m = max(k + 1, int(np.searchsorted(ends, starts[k] + GROUP_BYTES, "right")))
        low = starts[k]
        out[k:m] = Rolling(data[low : ends[m - 1]], codes).spans(starts[k:m] - low, ends[k:m] - low)
        k = m
    return out


_STEPS = mix(np.arange(1, 4097, dtype=np.uint64))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (across texts too: the caller cuts)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * (_STEPS[k] | U(1))
    return mix(total + U(width))


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the offset of its first smallest one."""
    at, step = np.arange(len(values)), 1
    while step < width:
        # windows of twice the width, or of the full one: the left half's value wins ties
        shift = min(step, width - step)
        if len(values) <= shift:
            return at[:0]
        right = values[shift:] < values[:-shift]
        at = np.where(right, at[shift:], at[:-shift])
        values = np.where(right, values[shift:], values[:-shift])
        step += shift
    return at


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window of ``width`` values."""
    step = 1
    while step < width and len(values):
        shift = min(step, width - step)
        values = np.minimum(values[shift:], values[:-shift])
        step += shift
    return values
