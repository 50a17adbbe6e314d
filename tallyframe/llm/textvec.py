"""Numpy views on Arrow text batches: bytes, words and word shingles without a loop per word.

Used inside Arrow tasks. Batches are cut into chunks of a few megabytes so that the working
arrays (about 60 bytes per byte of text) stay small; a longer text makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SHINGLE_WORDS = 5
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: 64-bit values whose bits look independent."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(z: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit hashes."""
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Bytes with A-Z in lower case.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, off - off[0] if len(off) else np.zeros(1, np.int64)


def chunks(batch: pa.RecordBatch, size: int = CHUNK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(lengths):
        return
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


_POWERS: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``count`` powers of the base of word hashes, and of its inverse; those of usual chunks are kept."""
    if not _POWERS or len(_POWERS[0]) < count:
        bits = max(16, int(count).bit_length())
        both = [np.full(1 << bits, np.uint64(base)) for base in (0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64))]
        for power in both:
            power[0] = 1
            np.multiply.accumulate(power, out=power)
        if bits > 22:
            return both[0], both[1]
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a chunk: hash, row, begin and end (byte positions in ``data``).

    ``lower`` folds all letters; ``fold`` maps bytes instead (as ``ASCII_LOWER`` does), and ``breaks``
    marks the bytes between words.
    """

    def __init__(self, column: pa.Array, lower: bool = True, fold: np.ndarray | None = None, breaks: np.ndarray = _BLANK):
        if lower and fold is None:
            column = pc.utf8_lower(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
        self.data, self.offsets = as_bytes(column)
        if fold is not None:
            self.data = fold[self.data]
        self.rows = len(self.offsets) - 1
        solid = ~breaks[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        cuts = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        first[cuts] = solid[cuts]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | first[1:]
        self.begin = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.offsets, self.begin, side="right") - 1
        self.count = np.bincount(self.row, minlength=self.rows).astype(np.int64) if len(self.row) else np.zeros(self.rows, np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.count)))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        size = (self.end - self.begin).astype(np.uint64) * GOLDEN
        with np.errstate(over="ignore"):
            # sums of byte codes times powers of their place in the word, from prefix sums over all bytes
            power, back = _powers(len(self.data))
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * power[:len(self.data)], out=total[1:])
            return mix((total[self.end] - total[self.begin]) * back[self.begin] + size)

    def shingles(self, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word (index in the row) of every shingle; a shorter text has one of all its words."""
        n = self.hash
        count = np.where(self.count >= width, self.count - width + 1, np.minimum(self.count, 1))
        ends = np.concatenate(([0], np.cumsum(count)))
        row = np.repeat(np.arange(self.rows), count)
        place = np.arange(ends[-1]) - np.repeat(ends[:-1], count)
        start = self.at[row] + place
        have = np.minimum(self.count, width)[row]
        h = np.zeros(len(row), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                there = k < have
                h = mix(h + GOLDEN + np.where(there, n[np.minimum(start + k, max(len(n) - 1, 0))] if len(n) else 0, np.uint64(k + 1)))
        return h, row, place


def multiset(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) in order of row and hash, with how often each occurs."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h)))
