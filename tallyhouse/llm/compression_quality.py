"""Text quality by compression: which of two dictionaries, of good and of bad text, shortens a text more.

A zstandard dictionary is trained for each label from a bounded sample of pieces of labelled texts. Every whole text is
compressed with both. The difference of the compressed sizes per byte, with the size per byte under the good dictionary
(text that repeats itself shrinks under either), is turned into a probability by a logistic curve fitted to other labelled
rows. Labels are learned only from rows whose CRC-32 of doc_id mod 3 is not 1. The curve is fitted crosswise: rows of
remainder 2 under dictionaries of remainder 0 and the other way round; the dictionaries that score hold both parts.
Documents are scored where they lie; nothing is shuffled.

Bounds, all parameters: ``dictionary_rows`` labelled rows and ``dictionary_pieces`` pieces per label and part,
``dictionary_bytes`` per dictionary, ``curve_rows`` rows per label and part for the curve. Rows and pieces are drawn by hash, at a rate that their
number gives, so reruns agree and no task sends more than its share to the driver.

Defined results: a null or empty text is scored as text that compresses to nothing; a null doc_id is not held out
and never learned from; repeated rows are scored alike; without labelled rows of both kinds the score is the share of
label 1, or 0.5. Columns other than doc_id, text and quality are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages, drawn, read

PIECE = 2000
DICTIONARY_BYTES = 256 << 10
DICTIONARY_ROWS = 8000
DICTIONARY_PIECES = 4000
CURVE_ROWS = 20_000
PARTS = (0, 2)  # remainders that may be learned from
LEVEL = 3
_FRAME = 12  # bytes of a frame that do not depend on the text


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _labelled(documents: DataFrame, labels: DataFrame, part: int, rows: int) -> DataFrame:
    """text and quality of about ``rows`` labelled ids per label; the ids are few enough to send to every task."""
    ids = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")).filter(
        F.col("id").isNotNull() & F.col("quality").isin(0, 1) & (remainder(F.col("id")) == part)).distinct()
    counts = {row["quality"]: row["n"] for row in ids.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = drawn(F.xxhash64("id"), counts.get(0, 0), rows)
    chosen = ids.filter(F.when(F.col("quality") == 1, drawn(F.xxhash64("id"), counts.get(1, 0), rows)).otherwise(share))
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")


def _dictionary(pieces: list[str], size: int) -> bytes:
    samples = [piece.encode() for piece in pieces]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the text itself serves
        return b"".join(samples)[-size:]


class Compressors:
    """One compressor per label, made from dictionaries in the task."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        made = []
        for raw in dictionaries:
            given = zstandard.ZstdCompressionDict(raw) if raw else None
            if given is not None:
                given.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=given))
        self.bad, self.good = made

    def features(self, text: bytes) -> tuple[float, float]:
        """(how much smaller the good dictionary makes the text than the bad one, its size), per byte."""
        if not text:
            return 0.0, 0.0
        good, bad = len(self.good.compress(text)), len(self.bad.compress(text))
        return (bad - good) / (len(text) + 1), (good - _FRAME) / (len(text) + 1)


def _features(batches: Iterator[pa.RecordBatch], dictionaries, keep: list[str]) -> Iterator[pa.RecordBatch]:
    compressors = Compressors(dictionaries.value)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        found = np.array([compressors.features(text.as_py() or b"") for text in texts], float).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in keep], pa.array(found[:, 0]), pa.array(found[:, 1])], [*keep, "difference", "size"])


def fit_curve(points: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps: weights of 1, difference and size."""
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.array([np.log(share / (1 - share)), 0.0, 0.0])
    middle, spread = points.mean(axis=0), points.std(axis=0) + 1e-9
    x = np.c_[np.ones(len(points)), (points - middle) / spread]
    weights = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        weights = weights + np.linalg.solve(hessian, x.T @ (labels - p) - 1e-2 * weights)
    return np.array([weights[0] - (weights[1:] * middle / spread).sum(), *(weights[1:] / spread)])


def train(documents: DataFrame, labels: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES,
          dictionary_rows: int = DICTIONARY_ROWS, dictionary_pieces: int = DICTIONARY_PIECES, curve_rows: int = CURVE_ROWS):
    """(broadcast dictionaries of bad and good text, weights of the curve)."""
    context, order, stages = documents.sparkSession.sparkContext, F.xxhash64("piece"), Stages(documents.sparkSession)
    pieces: dict[int, list[list[str]]] = {}
    for part in PARTS:
        samples = stages.keep(_labelled(documents, labels, part, dictionary_rows).filter("text != ''").select("quality", F.explode(F.transform(
            F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE)),
            lambda i: F.substring(F.col("text"), (i * PIECE + 1).cast("int"), F.lit(PIECE)))).alias("piece")).distinct())
        pieces[part] = []
        for label in (0, 1):
            own = samples.filter(F.col("quality") == label)
            few = own.filter(drawn(order, own.count(), dictionary_pieces))
            pieces[part].append([row.piece for row in few.orderBy(order, "piece").limit(dictionary_pieces).collect()])
    points = []
    for part, other in zip(PARTS, reversed(PARTS), strict=True):
        theirs = context.broadcast(tuple(_dictionary(p, dictionary_bytes) for p in pieces[other]))
        found = _labelled(documents, labels, part, curve_rows).select("text", "quality").mapInArrow(
            partial(_features, dictionaries=theirs, keep=["quality"]), "quality int, difference double, size double")
        points.append(found.toPandas())
    rows = pd.concat(points)
    weights = fit_curve(rows[["difference", "size"]].to_numpy(float), rows["quality"].to_numpy(float))
    dictionaries = context.broadcast(tuple(
        _dictionary(first + second, dictionary_bytes) for first, second in zip(*pieces.values(), strict=True)))
    return dictionaries, weights


def score(documents: DataFrame, dictionaries, weights: np.ndarray) -> DataFrame:
    """Per document: doc_id, difference, size, score."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(partial(_features, dictionaries=dictionaries, keep=["doc_id"]),
                            "doc_id long, difference double, size double")
    z = F.lit(float(weights[0])) + F.col("difference") * float(weights[1]) + F.col("size") * float(weights[2])
    return found.withColumn("score", 1 / (1 + F.exp(-z)))


def op5_compression_quality(spark, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    dictionaries, weights = train(documents, read(spark, sf_dir, "labels"))
    return score(documents, dictionaries, weights).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
