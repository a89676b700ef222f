"""Shards by jump consistent hashing of a stable key.

The shard of a key depends on the key and the number of shards alone, so there is no ring table, and with one shard
more a key either stays or moves to the new shard. Keys are hashed to 64 bits first. Within a shard rows get gapless slots in
an order fixed by key and text: rows are counted in small buckets, and a slot is the rows in the buckets before plus the
place in the bucket, so a shard is never sorted in one task.

Defined results: a null key is a key of its own; a null text has size 1 (no bytes, plus 1) and checksum 0; repeated rows
get slots of their own; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyhouse.llm.common import read

SHARDS = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: the last jump of a pseudorandom walk that stays below ``shards``."""
    state = keys.astype(np.uint64)
    shard, jump = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = jump[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (shard[moving] + 1) * (float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1))
        jump[moving] = np.minimum(step, 2.0**62).astype(np.int64)
        moving = moving[jump[moving] < shards]
    return shard


def _assign(batches: Iterator[pa.RecordBatch], counts: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
        found = [pa.array(jump_hash(keys, n), pa.int32()) for n in counts]
        yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *[f"__shard{n}" for n in counts]])


def shard_of(frame: DataFrame, key: str, counts: tuple[int, ...]) -> DataFrame:
    """``frame`` with the key's hash, ``__hash``, and a column ``__shard<n>`` for each number of shards."""
    hashed = frame.withColumn("__hash", F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("~null"))))
    schema = StructType([*hashed.schema.fields, *[StructField(f"__shard{n}", IntegerType()) for n in counts]])
    return hashed.mapInArrow(partial(_assign, counts=counts), schema)


def assign_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    rows = shard_of(rows, "doc_id", (shards, shards + 1))
    buckets = max(1, math.isqrt(documents.count() // shards))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("__hash", "text_crc32", "size"), F.lit(buckets)))
    shard = F.col(f"__shard{shards}")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(shard.alias("shard"), "bucket").agg(F.count("*").alias("rows")).select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("__hash", "doc_id", "text_crc32", "size")
    return rows.withColumn("shard", shard).withColumn("place", F.row_number().over(inside) - 1).join(
        offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("place")).alias("slot"),
        F.col(f"__shard{shards + 1}").alias("grown_shard"))


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with all their columns as one folder per shard (``shard=<n>``)."""
    sharded = with_shard(documents, shards)
    sharded.write.partitionBy("shard").parquet(path)


def with_shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard; a column of that name is replaced."""
    kept = documents.drop("shard")
    # Under plain names while the shards are found, so that no name of the documents is in the way.
    plain = kept.select(*[F.col(f"`{c}`").alias("doc_id" if c == "doc_id" else f"c{i}") for i, c in enumerate(kept.columns)])
    placed = shard_of(plain, "doc_id", (shards,)).drop("__hash")
    return placed.toDF(*kept.columns, "shard")


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))
