"""How large tables and results lie on disk: dealt out by key into sorted buckets, or as files in order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.sinks.stages import CODEC, tidy_writes
from tallyhouse.sources.schemas import canonical

# Key by which the reports join and sum each large table.
BUCKET_KEYS = {
    "TxTransaction": "TxInvoiceId",
    "TxInvoice": "TxInvoiceID",
    "MemberAgreementInvoiceRequest": "TxInvoiceId",
    "MemberAgreement": "MemberAgreementId",
    "MemberAgreementGroupRole": "MemberAgreementId",
    "MemberAgreementItem": "MemberAgreementId",
    "MemberAgreementSalesAdviser": "MemberAgreementId",
}


def write_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int,
                   keys: Mapping[str, str] | None = None) -> None:
    """Write tables into ``database`` in sorted buckets, so that joins and sums by their keys need no shuffle.

    All have the same number of buckets, which should keep a bucket near the size of a task's share (128 to 512 MB). Rows are dealt
    out by key before they are written: one file per bucket and not one per task and bucket. A key that holds
    very many rows makes one large bucket; leave such a table out of ``keys`` and let the shuffle split it.
    """
    for name, key in (keys or BUCKET_KEYS).items():
        table = canonical(name)
        dealt = tables[table].repartition(buckets, F.col(key))
        with tidy_writes(dealt.sparkSession):
            dealt.write.mode("overwrite").option("compression", CODEC).bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{table}")


def sorted_files(frame: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows dealt out by ranges of ``order`` and sorted within each: written, the files are in order one after the other.

    No task sorts everything. Equal keys stay together, so end the order with columns that tell rows apart.
    """
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)
