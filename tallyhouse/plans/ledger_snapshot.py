"""What the receivables reports need of the ledger, kept up to a posting day and completed by the days since.

A snapshot has one row per invoice line for everything dated before its ``cut``, and one per line and moment for what is dated later,
so that the amount due can be told for any date from the cut on. Every column can be added up or compared, so the snapshot
and the days posted since are merged by one aggregate, which combines before the shuffle. Rows of settled invoices lie apart
and are read only for invoices that the new days touch.

Ledger rows lie in one folder per posting day. That is the day on which they were added, whatever date they carry: a late
row with an old date is counted by the next run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import moment
from tallyhouse.operators import credit_negative, credit_positive, restrict_to_keys
from tallyhouse.sinks.files import Files
from tallyhouse.sinks.generations import Generation, Generations
from tallyhouse.sinks.stages import CODEC, StageArea, tidy_writes
from tallyhouse.sources.schemas import declared

col = F.col
POSTED = "posted"
_LINE = ["invoice_id", "line_no"]
_MONEY = "decimal(29,4)"
_SCHEMA = (f"invoice_id bigint, line_no int, at timestamp_ntz, dated boolean, balance {_MONEY}, due {_MONEY}, first_tx bigint, "
           "first_item bigint, last_tx bigint, last_item bigint, is_open boolean")
_MERGED = {
    "balance": f"cast(sum(balance) as {_MONEY})", "due": f"cast(sum(due) as {_MONEY})", "first_tx": "min(first_tx)",
    "first_item": "min_by(first_item, first_tx)", "last_tx": "max(last_tx)", "last_item": "max_by(last_item, last_tx)",
}


class DayLedger:
    """Ledger rows by posting day below ``root``. A day is written as a whole, and writing it again replaces it."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root.rstrip("/")

    def write_day(self, day: date, rows: DataFrame) -> None:
        with tidy_writes(self._spark):
            rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/{POSTED}={day.isoformat()}")

    def days(self) -> list[date]:
        names = Files(self._spark).names(self.root)
        return sorted(date.fromisoformat(name.split("=", 1)[1]) for name in names if name.startswith(f"{POSTED}="))

    def rows(self) -> DataFrame:
        """All rows with their posting day; a filter on it reads only the folders of these days."""
        schema = declared("TxTransaction").add(POSTED, "date")
        return self._spark.read.schema(schema).parquet(self.root)


def line_facts(ledger: DataFrame, cut: datetime) -> DataFrame:
    """Per line, and per moment from the cut on: balance, amount due, first item and last payment. ``at`` is null before the cut."""
    payment = f"TxTypeID = {fixed.TX_TYPE_PAYMENT}"
    # Dealt out by invoice: a line has few transactions, and what reads the facts sums them up or finds them by invoice.
    return ledger.filter("TxInvoiceId is not null").repartition("TxInvoiceId").groupBy(
        col("TxInvoiceId").alias("invoice_id"), col("GroupId").alias("line_no"),
        F.when(col("TargetDate") >= moment(cut), col("TargetDate")).alias("at"), col("TargetDate").isNotNull().alias("dated"),
    ).agg(
        F.sum(credit_positive(col("IsAccountingCredit"), col("Amount"))).cast(_MONEY).alias("balance"),
        F.sum(credit_negative(col("IsAccountingCredit"), col("Amount"))).cast(_MONEY).alias("due"),
        F.min("TxTransactionID").alias("first_tx"), F.expr("min_by(ItemId, TxTransactionID) as first_item"),
        F.expr(f"max(case when {payment} then TxTransactionID end) as last_tx"),
        F.expr(f"max_by(ItemId, case when {payment} then TxTransactionID end) as last_item"),
    )


def _merged(facts: DataFrame, keys: list) -> DataFrame:
    return facts.groupBy(*keys).agg(*[F.expr(f"{how} as {name}") for name, how in _MERGED.items()])


@dataclass(frozen=True)
class SnapshotView:
    """The ledger as the reports see it: a snapshot and the days posted after it."""

    facts: DataFrame
    since: DataFrame
    cut: datetime
    stages: StageArea

    def _rows(self, until: datetime | None) -> DataFrame:
        """Facts of all invoices that may be open: those open in the snapshot, and settled ones that something later concerns."""
        settled, new = self.facts.filter("not is_open"), line_facts(self.since, self.cut)
        awake = new.select("invoice_id")
        if until is not None:
            # Settled now, but not by what was dated before ``until``.
            later = (col("at") >= moment(until)) | ~col("dated")
            awake = awake.unionByName(settled.filter(later).select("invoice_id"))
        woken = restrict_to_keys(settled, "invoice_id", awake.distinct())
        return self.facts.filter("is_open").unionByName(woken).drop("is_open").unionByName(new)

    def lines(self, as_of: datetime, until: datetime | None = None) -> DataFrame:
        """Per line: its balance (at ``until``, else over all time), the amount due at ``as_of``, first item and last payment; kept as a stage."""
        if as_of < self.cut or (until is not None and until < self.cut):
            raise ValueError(f"the snapshot tells dates from {self.cut} on; earlier ones need the whole ledger")
        before = col("dated") & (col("at").isNull() | (col("at") < moment(as_of)))
        rows = self._rows(until).withColumn("due", F.when(before, col("due")))
        if until is not None:
            rows = rows.withColumn("balance", F.when(col("dated") & (col("at").isNull() | (col("at") < moment(until))), col("balance")))
        return self.stages.keep(_merged(rows, _LINE), "ledger_facts")


class LedgerSnapshot:
    """Snapshots of a ledger below ``root``, each a generation of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._log = spark, Generations(spark, root)

    def latest(self) -> Generation | None:
        return self._log.latest()

    def through(self) -> date | None:
        """The last posting day that the latest snapshot holds."""
        latest = self.latest()
        return date.fromisoformat(latest.facts["through"]) if latest else None

    def advance(self, ledger: DataFrame, *, through: date, cut: datetime, keep: int = 2) -> Generation | None:
        """Fold the days up to ``through`` into a new snapshot. Only days after the last one are read, and the last one itself.

        ``cut`` never goes back. A snapshot that already holds the day is returned; None tells that another run was first.
        """
        latest = self.latest()
        base = latest.number if latest else 0
        new = ledger.filter(col(POSTED) <= F.lit(through))
        if latest:
            done, last_cut = date.fromisoformat(latest.facts["through"]), datetime.fromisoformat(latest.facts["cut"])
            if through <= done:
                return latest
            if cut < last_cut:
                raise ValueError(f"the cut is at {last_cut} already")
            new = new.filter(col(POSTED) > F.lit(done))
        facts = line_facts(new, cut)
        if latest:
            facts = _merged(self._log.read(latest, _SCHEMA).drop("is_open").unionByName(facts), [
                *_LINE, F.when(col("at") >= moment(cut), col("at")).alias("at"), "dated"])
        with StageArea(self._spark) as stages:
            facts = stages.keep(facts, "facts")
            open_ids = facts.groupBy("invoice_id").agg(F.sum("balance").alias("total")).filter("total != 0").select(
                col("invoice_id").alias("open_id"))
            marked = facts.join(open_ids, col("invoice_id") == col("open_id"), "left").withColumn(
                "is_open", col("open_id").isNotNull()).drop("open_id")
            # Finding the ranges runs what comes before them once more: a stage, so that the join's shuffle is gone by then.
            marked = stages.keep(marked, "marked")
            stages.drop("facts")
            folder = self._log.attempt()
            order = ["is_open", "invoice_id", "line_no"]
            with tidy_writes(self._spark):
                marked.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("is_open").option("compression", CODEC).parquet(folder)
        published = self._log.commit(base, folder, {"through": through.isoformat(), "cut": cut.isoformat()})
        if published is None:
            self._log.discard(folder)
            return None
        self._log.sweep(keep)
        return published

    def view(self, ledger: DataFrame, stages: StageArea) -> SnapshotView:
        """The latest snapshot with the days posted after it."""
        latest = self.latest()
        if latest is None:
            raise ValueError("there is no snapshot yet")
        through, cut = date.fromisoformat(latest.facts["through"]), datetime.fromisoformat(latest.facts["cut"])
        return SnapshotView(self._log.read(latest, _SCHEMA), ledger.filter(col(POSTED) > F.lit(through)), cut, stages)
