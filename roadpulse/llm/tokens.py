"""Words, word hashes and n-gram hashes of whole Arrow text columns, computed with numpy.

All functions work on slices of a batch (about 256 KB of text, or one longer text), so memory
follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP, _GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= _MIX_A
    v ^= v >> np.uint64(27)
    v *= _MIX_B
    v ^= v >> np.uint64(31)
    return v


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


class _Powers:
    """Powers of an odd multiplier and of its inverse, grown when needed."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            grown = []
            for base in (self.base, _inverse(self.base)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                grown.append(np.multiply.accumulate(factors))
            self.up, self.down = grown
        return self.up, self.down


_BYTE_POWERS, _GRAM_POWERS = _Powers(_STEP), _Powers(_GRAM)


def separators(chars: bytes) -> np.ndarray:
    """A table that is True at the bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(chars)] = False
    return table


#: Words are runs of anything but ASCII white space.
WHITE = separators(b" \t\n\x0b\x0c\r")
#: Words are runs of ASCII letters, digits and non-ASCII characters.
PLAIN = separators(bytes(c for c in range(128) if not chr(c).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of several texts: text index, byte start, byte length and hash of each word."""

    counts: np.ndarray  # words of each text
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def first(self) -> np.ndarray:
        """The index of each text's first word, and the number of all words."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes: first row, end row, bytes, bounds."""
    if not len(column):
        return
    data, bounds = as_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the bounds of the texts."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    begin[heads] = inside[heads]
    stop[tails] = inside[tails]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each span; ``start`` and ``end`` ascend. ``fold`` maps bytes first."""
    table = _BYTE if fold is None else _BYTE[fold]
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        to = max(at + 1, int(np.searchsorted(end, low + SLICE_BYTES, "right")))
        block = data[low : end[to - 1]]
        up, down = _BYTE_POWERS.upto(len(block))
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(table[block] * up[: len(block)], out=total[1:])
        a, b = start[at:to] - low, end[at:to] - low
        out[at:to] = (total[b] - total[a]) * down[a]
        at = to
    return mix(out)


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray = WHITE, fold: np.ndarray | None = None) -> Words:
    start, end = spans(table[data], bounds)
    counts = np.diff(np.searchsorted(start, bounds))
    return Words(counts, start, end - start, hash_spans(data, start, end, fold))


def grams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which an n-gram of one text starts, and the n-grams' hashes."""
    total = len(found.hash)
    if total < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _GRAM_POWERS.upto(total)
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(found.hash * up[:total], out=sums[1:])
    text = found.text
    at = np.flatnonzero(text[n - 1 :] == text[: total - n + 1])
    return at, mix((sums[at + n] - sums[at]) * down[at])


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def sums_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups with the given sizes; empty groups give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.astype(np.uint64, copy=False).view(np.int64)
