"""Texts and sorted numbers in compressed form, for rows that are shuffled once and read in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

_UNPACKER = zstandard.ZstdDecompressor()


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column ``text`` by ``packed``, the last column; a null text stays null."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        packed = pa.array([None if t.as_py() is None else packer.compress(t.as_py()) for t in texts], pa.binary())
        others = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in others], packed], [*others, "packed"])


def unpack_texts(packed: pa.Array | pa.ChunkedArray) -> pa.Array:
    texts = [b"" if t is None else _UNPACKER.decompress(t) for t in packed.to_pylist()]
    return pa.array(texts, pa.large_binary()).cast(pa.large_string())


def pack_numbers(values: np.ndarray) -> bytes:
    """Integers byte by byte position, so that equal high bytes compress away."""
    planes = np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNPACKER.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack_numbers(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(packed), dtype=np.uint64)
