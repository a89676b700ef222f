"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

Texts stay in their Arrow buffer: words are found by comparing neighbouring bytes and hashed with a
polynomial over a random value per byte (64 bits, mixed with the length), so no Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table by byte that is true in the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACES = byte_table([(0x09, 0x0D), (0x20, 0x20)])
NOT_ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, np.uint64(base))
    powers[0] = 1
    return np.multiply.accumulate(powers)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Words:
    """The words of a run of texts: ``start`` and ``stop`` in ``data``, and the first word of each text in ``first``."""

    def __init__(self, texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.data = LOWER[data] if lower else data
        inside = ~separators[self.data]
        n = len(inside)
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[self.offsets[:-1][self.offsets[:-1] < n]] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[self.offsets[1:][self.offsets[1:] > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.stop = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        values, low = _byte_values(), 0
        while low < len(self):
            # As many words as end within a slice of bytes, one at least.
            begin = self.start[low]
            high = max(low + 1, int(np.searchsorted(self.stop, begin + SLICE_BYTES, "right")))
            part = self.data[begin : self.stop[high - 1]]
            size = max(SLICE_BYTES, len(part)) + 1
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * _powers(int(_BASE), size)[: len(part)], out=sums[1:])
            start, stop = self.start[low:high] - begin, self.stop[low:high] - begin
            total = (sums[stop] - sums[start]) * _powers(int(_INVERSE), size)[start]
            out[low:high] = mixed(total + (stop - start).astype(np.uint64) * _STEP)
            low = high
        return out

    def text(self, row: int, keep: np.ndarray) -> bytes:
        """The kept words of a text, joined by one space."""
        low, high = self.first[row], self.first[row + 1]
        if low == high or not keep.any():
            return b""
        data = self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()
        base = self.offsets[row]
        start, stop = self.start[low:high][keep] - base, self.stop[low:high][keep] - base
        return b" ".join([data[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words; windows that leave their text are the caller's to drop."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count].copy()
    for shift in range(1, size):
        total *= _BASE
        total += hashes[shift : shift + count]
    return mixed(total + np.uint64(size * int(_STEP) % 2**64))


def inside_text(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` words of one text begin."""
    counts = np.diff(first)
    room = np.maximum(counts - size + 1, 0)
    starts = np.repeat(first[:-1] - (np.cumsum(room) - room), room)
    return starts + np.arange(room.sum())


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with up to ``limit`` bytes of text and SLICE_ROWS rows; a longer text stands alone, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        low = 0
        while low < batch.num_rows:
            begun = ends[low] - size[low]
            high = max(low + 1, min(low + SLICE_ROWS, int(np.searchsorted(ends, begun + limit, "right"))))
            yield batch.slice(low, high - low)
            low = high


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def runs_of(values: list[np.ndarray] | np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
