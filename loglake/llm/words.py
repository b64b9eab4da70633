"""Words and their hashes for whole Arrow batches of texts, without a loop over words.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Hashes are 64 bits wide and depend on the bytes of a word only, so they
agree between tasks, runs and machines. All arrays of one slice are a small multiple of
``SLICE_BYTES``; a text longer than that forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: An odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        factors = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        known = np.multiply.accumulate(factors)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:size]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string()).fill_null("")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Slice:
    """Some neighbouring texts of a batch: rows ``low`` to ``high``."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return self.high - self.low

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """Index of the text (within the slice) that holds each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Every text of the column, in order, in slices of about ``limit`` bytes."""
    data, offsets = utf8(column)
    low, count = 0, len(offsets) - 1
    while low < count:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), count)
        begin, end = offsets[low], offsets[high]
        yield Slice(low, high, data[begin:end], offsets[low : high + 1] - begin)
        low = high


class Hasher:
    """Hashes of any byte ranges of one slice, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        size = len(data)
        terms = _BYTE_VALUE[data]
        terms *= _power(_BASE, size)
        self.prefix = np.zeros(size + 1, np.uint64)
        np.cumsum(terms, out=self.prefix[1:])
        self.back = _power(_INVERSE, size + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of flagged bytes; no run crosses a text's end."""
    size = len(inside)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(size + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0] = edge[-1] = True
    edge[offsets] = True
    at = np.flatnonzero(edge)
    first = inside[at[:-1]]
    return at[:-1][first], at[1:][first]


@dataclass
class Words:
    """Words of a slice: byte range, text (within the slice) and hash of each."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word, n + 1 values

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(piece: Slice, lower: bool = False) -> Words:
    """Words of every text of a slice; ``lower`` folds A-Z."""
    start, end = runs(~IS_SPACE[piece.data], piece.offsets)
    text = piece.text_of(start)
    hashes = Hasher(LOWER[piece.data] if lower else piece.data).ranges(start, end)
    first = np.searchsorted(text, np.arange(piece.size + 1))
    return Words(start, end, text, hashes, first)


def shingles(found: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``length`` words inside one text, and its first word."""
    count = len(found.hash) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for k in range(length):
        factor = np.uint64(pow(_BASE, k + 1, 1 << 64))
        total += found.hash[k : k + count] * factor
    at = np.flatnonzero(found.text[:count] == found.text[length - 1 :])
    return mix(total[at]), at
