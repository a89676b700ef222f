"""Count tables of a fixed size: counted per task, summed by chunk over the cluster, then read by the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import shuffle_partitions
from tallyhouse.llm.words import runs_of

CHUNK = 4096
SCHEMA = "chunk int, counts array<long>"


def padded_size(size: int) -> int:
    return -(-size // CHUNK) * CHUNK


def chunks_of(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunks of a task's table that hold a count. Its size is a multiple of CHUNK."""
    rows = table.reshape(-1, CHUNK)
    used = np.flatnonzero(rows.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), runs_of(rows[used].reshape(-1), np.full(len(used), CHUNK), pa.int64())],
            ["chunk", "counts"])


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk; at most the task's share of the table is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        values = batch.column("counts").flatten().to_numpy().reshape(-1, CHUNK)
        for chunk, row in zip(batch.column("chunk").to_pylist(), values, strict=True):
            sums[chunk] = sums[chunk] + row if chunk in sums else row.copy()
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), runs_of(np.concatenate(list(sums.values())), np.full(len(sums), CHUNK), pa.int64())],
            ["chunk", "counts"])


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' tables (frames of SCHEMA); ``size`` entries, however many rows were counted."""
    sums = parts.repartition(min(64, shuffle_partitions(parts.sparkSession)), "chunk").mapInArrow(_sum_chunks, SCHEMA)
    table = np.zeros((padded_size(size) // CHUNK, CHUNK), np.int64)
    for row in sums.toArrow().to_pylist():
        table[row["chunk"]] = row["counts"]
    return table.reshape(-1)[:size]
