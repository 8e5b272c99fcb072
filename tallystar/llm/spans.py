"""Words and lines of Arrow text columns as numpy arrays, without a Python object per word.

White space is ``[\\x20\\x09-\\x0D]`` everywhere. UTF-8 never has these bytes inside a
longer character, so spans are found on the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TABLE = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FAR = np.uint64(0x9E3779B97F4A7C15)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes, the same in every process."""
    lens = ends - starts
    if not len(lens):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    values = _TABLE[((within & 63) << 8) | buf[np.repeat(starts, lens) + within]]
    if lens.max() > 64:
        values *= mix((within >> 6).astype(np.uint64) * _FAR) | np.uint64(1)
    sums = np.add.reduceat(values, first)
    return mix(sums + lens.astype(np.uint64) * _FAR)


@dataclass
class Texts:
    """Some consecutive texts of a batch. ``bounds[i]:bounds[i+1]`` are the bytes of text i."""

    rows: slice
    buf: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the number of the first word of each text."""
        inside = ~SPACE[self.buf]
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        before[self.bounds[:-1][self.bounds[:-1] < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        cuts = self.bounds[1:]
        after[cuts[(cuts > 0)] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines (split at \\n), and the number of each text's first line."""
        breaks = np.flatnonzero(self.buf == 0x0A)
        starts = np.sort(np.concatenate([self.bounds[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.bounds[1:], breaks]), kind="stable")
        count = 1 + np.diff(np.searchsorted(breaks, self.bounds))
        return starts, ends, np.concatenate([[0], np.cumsum(count)])


def texts(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a string column in slices of bounded size; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), len(column))
        bounds = offsets[row : end + 1] - offsets[row]
        yield Texts(slice(row, end), data[offsets[row] : offsets[end]], bounds)
        row = end


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word or line, from the numbers of the first of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
