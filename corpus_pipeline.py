"""From raw documents to sharded training text: the stages in order, each an operator of ``tallyhouse.llm``.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.common import Stages, read
from tallyhouse.llm.decontaminate import without_contaminated
from tallyhouse.llm.jaccard_join import one_of_each
from tallyhouse.llm.mixing import mixed_documents
from tallyhouse.llm.quality_rules import without_rejected
from tallyhouse.llm.sharding import with_shard

# SQL has no 64-bit xxHash for the shards; the tests hold every stage against DuckDB or brute force instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that too many documents of a source share are cut out of the others."""
    return without_rejected(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest doc_id stays."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages in 5 % of their words or more go."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a row for each pass that takes words of a document."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets the shard of its doc_id."""
    return with_shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stages = Stages(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stages.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
