"""Declared types of the reports, before the checks turn decimals into doubles."""

from datetime import datetime

import pytest

from tallyhouse.plans.ar_aging import ar_aging
from tallyhouse.plans.daily_payments import daily_batch, daily_pos
from tallyhouse.plans.net_members import net_member_count
from tallyhouse.plans.unmatched import unmatched_payments, unmatched_totals
from tallyhouse.sinks.stages import NoStages
from tallyhouse.testbed.operator_queries import OPERATORS

NOW, STAGES = datetime(2024, 1, 1), NoStages()
MONEY = "decimal(38,4)"
REPORTS = {
    "ar": (lambda t: ar_aging(t, now=NOW, stages=STAGES), {
        "TotalDue": MONEY, "AgingCurrent": MONEY, "AR_121_and_Up": MONEY, "InvoiceDate": "date", "DueDate": "date",
        "CancelDate": "timestamp_ntz"}),
    "net": (lambda t: net_member_count(t, now=NOW, stages=STAGES), {
        "AGREEMENT_MONTHLYDUES": "decimal(12,2)", "FIRSTINVOICEDATE": "timestamp_ntz"}),
    # A tenant that the fixed list does not name.
    "pos": (lambda t: daily_pos(t, now=NOW, tenant="third", exclusion_report="Third", stages=STAGES).rows, {"TransactionAmount": MONEY}),
    "batch": (lambda t: daily_batch(t, now=NOW, tenant="third", exclusion_report="Third", stages=STAGES).rows, {"TransactionAmount": MONEY}),
    "unmatched": (lambda t: unmatched_payments(t, since=NOW), {"Amount": "decimal(19,4)"}),
    "totals": (lambda t: unmatched_totals(t, unmatched_payments(t, since=NOW), as_of=NOW, stages=STAGES), {
        "Amount": MONEY, "PaymentAmount": "decimal(19,4)"}),
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_types(billing, name):
    report, wanted = REPORTS[name]
    types = dict(report(billing()).dtypes)
    assert {column: types[column] for column in wanted} == wanted


@pytest.mark.parametrize("name, column, kind", [
    ("ar_aging_buckets", "total_due", "decimal(38,4)"), ("typed_insert", "monthly", "decimal(12,2)"),
    ("open_invoice_balance", "balance", "decimal(29,4)"), ("computed_group_key", None, None),
])
def test_operator_types(spark, sf_dir, name, column, kind):
    types = dict(OPERATORS[name](spark, sf_dir).dtypes)
    if column:
        assert types[column] == kind
    assert not {k for k, v in types.items() if v == "float"}


def test_totals_without_the_wide_report(spark, sf_dir):
    """The reconciliation reads no contact, item or agreement table."""
    from tallyhouse.testbed.adapter import billing_tables

    class Seen(dict):
        def __missing__(self, key):
            used.append(key)
            return tables[key]

    tables, used = billing_tables(spark, sf_dir), []
    unmatched_totals(Seen(), unmatched_payments(Seen(), since=datetime(1998, 1, 1)), as_of=datetime(2000, 1, 1))
    assert not [t for t in used if "Mechanism" in t or "Item" in t or t in ("Agreement", "MemberAgreement", "CheckIn")]


def test_request_items_are_cut_before_they_meet_requests(billing):
    from tallyhouse.plans.net_members import first_bill_dates, key_items

    tables = billing()
    counted = tables["MemberAgreement"].selectExpr("MemberAgreementId as agreement_id")
    invoiced = tables["MemberAgreementInvoiceRequest"].selectExpr("MemberAgreementId as agreement_id", "TxInvoiceId as invoice_id")
    frame = first_bill_dates(tables, key_items(tables, counted), invoiced)
    joins = [line for line in frame._jdf.queryExecution().analyzed().toString().split("\n") if "Join" in line]
    at = {key: next(i for i, line in enumerate(joins) if f"({key}#" in line) for key in ("request_id", "item_id")}
    assert at["request_id"] < at["item_id"] and any("LeftSemi" in line for line in joins)
