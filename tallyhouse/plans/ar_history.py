"""Receivables as of many dates in one pass over the ledger.

Each transaction is an event in the first date's period that it counts in. Events are added up per line and period once; running
sums tell from which date to which an invoice is open and how much is due on a line. Lines go through the report once per
stretch of dates with the same amount, and are spread out over the dates at its end, so that the number of dates adds neither scans
nor rows to be shuffled or written; what is settled costs nothing more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import moment
from tallyhouse.operators import credit_negative, credit_positive, restrict_to_keys
from tallyhouse.plans.ar_aging import (
    LINE, agreement_info, amounts_due, final_rows, invoice_headers, invoice_shares, member_detail, open_details,
)
from tallyhouse.sinks.stages import StageArea
from tallyhouse.sources.tables import bucketed_by

col = F.col
_MONEY = "decimal(29,4)"


def balance_events(tables: Mapping[str, DataFrame], dates: Sequence[datetime]) -> DataFrame:
    """Per line and period: change of the balance and of the amount due, first item and last payment.

    Period ``k`` counts at the dates from the k-th on (before a date, as the single report counts); those after the last
    date, and those without one, are in a period of their own, which counts at none.
    """
    payment = f"TxTypeID = {fixed.TX_TYPE_PAYMENT}"
    passed = F.lit(0)
    for date in dates:
        passed = passed + F.when(col("TargetDate") >= moment(date), 1).otherwise(0)
    period = F.when(col("TargetDate").isNull(), len(dates)).otherwise(passed)
    ledger = tables["TxTransaction"].filter("TxInvoiceId is not null")
    # By invoice, as everything that reads the events wants them: an invoice's periods then combine in the task that reads them.
    return (ledger if bucketed_by(tables, "TxTransaction", "TxInvoiceId") else ledger.repartition("TxInvoiceId")).groupBy(
        col("TxInvoiceId").alias("invoice_id"), col("GroupId").alias("line_no"), period.alias("k")
    ).agg(
        F.sum(credit_positive(col("IsAccountingCredit"), col("Amount"))).alias("balance"),
        F.sum(credit_negative(col("IsAccountingCredit"), col("Amount"))).alias("due"),
        F.min("TxTransactionID").alias("first_tx"), F.expr("min_by(ItemId, TxTransactionID) as first_item"),
        F.expr(f"max(case when {payment} then TxTransactionID end) as last_tx"),
        F.expr(f"max_by(ItemId, case when {payment} then TxTransactionID end) as last_item"),
    )


def stretches(events: DataFrame, keys: Sequence[str], amount: str, dates: int) -> DataFrame:
    """Runs of dates over which the running sum of an amount stays the same and is not zero: ``from_k`` to ``to_k``, both included.

    A key has at most one row per period, however many transactions it has.
    """
    window = f"over (partition by {', '.join(keys)} order by k"
    return events.filter(f"k < {dates}").selectExpr(
        *keys, "k as from_k", f"lead(k, 1, {dates}) {window}) - 1 as to_k",
        f"cast(sum({amount}) {window} rows between unbounded preceding and current row) as {_MONEY}) as {amount}",
    ).filter(f"{amount} != 0")


def overlaps(due: DataFrame, open_at: DataFrame) -> DataFrame:
    """Amounts due over the parts of their stretches at which their invoice is open; an invoice with several headers counts as often."""
    open_part = open_at.groupBy("invoice_id", col("from_k").alias("open_from"), col("to_k").alias("open_to")).agg(
        F.count("*").cast("decimal(9,0)").alias("headers"))
    return due.join(open_part, "invoice_id").withColumns({
        "from_k": F.greatest("from_k", "open_from"), "to_k": F.least("to_k", "open_to"), "due": (col("due") * col("headers")).cast(_MONEY),
    }).filter("from_k <= to_k").drop("open_from", "open_to", "headers")


def ar_aging_history(
    tables: Mapping[str, DataFrame], *, dates: Sequence[datetime], now: datetime, stages: StageArea | None = None,
) -> DataFrame:
    """The aging report with the balances of each date (``ar_aging`` with ``point_in_time``), told apart by ReportDate.

    Owners, agreements and contacts are those of ``now``, as in the single report, and are looked up once.
    """
    dates = sorted(set(dates))
    if not dates:
        raise ValueError("name at least one date")
    stages = stages or StageArea(tables["TxTransaction"].sparkSession)
    events = stages.keep(balance_events(tables, dates), "balance_events")
    by_invoice = events.groupBy("invoice_id", "k").agg(F.sum("balance").alias("balance"))
    open_at = stretches(by_invoice, ["invoice_id"], "balance", len(dates))
    open_at = stages.keep(open_at.join(invoice_headers(tables), "invoice_id"), "open_stretches")
    invoices = open_at.drop("from_k", "to_k", "balance").distinct()
    of_open = restrict_to_keys(events, "invoice_id", open_at.select("invoice_id").distinct())
    # First item and last payment look at the whole ledger, whatever the date.
    items = of_open.groupBy(*LINE).agg(
        F.expr("if(line_no is null, null, min_by(first_item, first_tx)) as first_item"), F.max("last_tx").alias("last_payment_tx"),
        F.expr("max_by(last_item, last_tx) as last_payment_id"))
    items = stages.keep(items, "line_items")
    due = overlaps(stretches(of_open, LINE, "due", len(dates)), open_at)
    same_line = [col("invoice_id") == col("item_invoice"), col("line_no").eqNullSafe(col("item_line"))]
    ledger = due.join(items.selectExpr("invoice_id as item_invoice", "line_no as item_line", "first_item"), same_line).drop("item_invoice", "item_line")
    amounts = stages.keep(amounts_due(ledger), "amounts")
    stages.drop("balance_events")
    details = stages.keep(open_details(tables, invoices, amounts), "details")
    agreements = stages.keep(agreement_info(tables, details, stages), "agreements")
    stages.drop("open_stretches", "member_agreements")
    shares = stages.keep(invoice_shares(tables, details, agreements, amounts), "shares")
    members = member_detail(tables, details, agreements, now)
    report = final_rows(tables, amounts, shares, members, items, as_of=None, now=now, dates=dates, stages=stages)
    stages.drop("details", "agreements", "line_items", "shares")
    return report
