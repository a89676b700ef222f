"""Row keys, stages and small column helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sinks.stages import owned_folder

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
LAST_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(frame: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text and ``extra`` with the row's key: ``dk`` (doc_id, null as the last id) and ``th`` (hash of the text).

    Other columns are left behind, so their names cannot clash. Rows repeated in both columns share a key.
    """
    return frame.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("dk"),
        F.xxhash64("text").alias("th"),
        F.col("text").cast("string").alias("text"),
        *[F.col(f"`{name}`") for name in extra],
    )


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(documents: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents with the key of each row in two more columns, and the names of these."""
    dk, th = unused(documents, "__dk"), unused(documents, "__th")
    return documents.withColumns({dk: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), th: F.xxhash64("text")}), dk, th


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_GRAINS = 1_000_000_000


def drawn(hash_: Column, total: int, wanted: int) -> Column:
    """Whether a row is among about ``wanted`` of ``total``, by its hash: no task has to hold or send more than its share.

    All rows where there are no more than wanted; else a tenth more than wanted is expected, for a limit to cut to size.
    """
    return F.lit(True) if total <= wanted else F.pmod(hash_, F.lit(_GRAINS)) < int(1.1 * wanted / total * _GRAINS)


class Stages:
    """Tables of one run in the shared folder: they cut the plan and survive the loss of executors.

    ``keep`` writes a frame and returns a scan of it. Each run has a folder of its own, which expires and is swept like all stages.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._folder, self._made = spark, owned_folder(spark, "llm"), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self._made += 1
        path = f"{self._folder}/{self._made}"
        frame.write.option("compression", "zstd").parquet(path)
        return self._spark.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
