"""Daily extracts on hand-built rows and as properties of the larger fixture."""

from collections import Counter
from datetime import datetime

import pytest

from tallyhouse.fixed_values import EXCLUSION_REPORTS
from tallyhouse.plans.daily_payments import daily_batch, daily_pos
from tallyhouse.testbed.adapter import billing_tables

NOW = datetime(2024, 5, 3, 7, 15)


def payment(key, at=datetime(2024, 5, 2, 10), **more):
    return {"TxPaymentID": key, "PartyRoleId": 5, "TargetDate": at, "Amount": 20, "TenderTypeID": 1,
            "TargetBusinessUnitId": 2, "IsDeclined": 0, **more}


def tx(key, item, amount=20, kind=4, invoice=1):
    return {"TxTransactionID": key, "ItemId": item, "TxTypeID": kind, "Amount": amount, "IsAccountingCredit": 1,
            "TxInvoiceId": invoice, "Description": "Payment"}


BASE = {
    "PartyRole": [{"PartyRoleID": 5, "PartyID": 50, "RoleID": "M5"}, {"PartyRoleID": 6, "PartyID": 60, "RoleID": None}],
    "BusinessUnit": [{"BusinessUnitId": 2, "Name": "Unit", "GLCodePrefix": "U2", "Code": "C2", "POSMerchantAccountCode": "POS2"}],
    "TxInvoice": [{"TxInvoiceID": 1, "TargetBusinessUnitId": 2, "TargetDate": datetime(2024, 5, 1)}],
}


def ids(extract):
    return sorted(r.TxPaymentID for r in extract.rows.collect())


def test_window_and_next_mark(billing):
    tables = billing(**BASE, TxPayment=[
        payment(1, datetime(2024, 5, 1, 23, 59, 59)), payment(2, datetime(2024, 5, 2)),
        payment(3, datetime(2024, 5, 2, 23, 59, 59)), payment(4, datetime(2024, 5, 3)), payment(5, None)])
    extract = daily_pos(tables, now=NOW, tenant="tsi")
    assert ids(extract) == [2, 3]
    assert (extract.low, extract.new_mark) == (datetime(2024, 5, 2), datetime(2024, 5, 3))
    following = daily_pos(tables, now=NOW, tenant="tsi", current_mark=extract.new_mark)
    assert ids(following) == [4]
    # A bound inside a day leaves out that day and takes in the last one.
    inside = daily_pos(tables, now=NOW, tenant="tsi", current_mark=datetime(2024, 5, 1, 12), new_mark=datetime(2024, 5, 3, 12))
    assert ids(inside) == [2, 3, 4]


def test_who_and_what_is_left_out(billing):
    pos, other, batch = EXCLUSION_REPORTS["pos", "tsi"], EXCLUSION_REPORTS["pos", "bfx"], EXCLUSION_REPORTS["batch", "tsi"]
    listed = [(pos, 0, "3"), (pos, 1, "4"), (other, 0, "4"), (pos, 0, "cash"), (batch, 0, "1")]
    tables = billing(**BASE, TxPayment=[
        payment(1), payment(2, PartyRoleId=6), payment(3, PartyRoleId=None), payment(4, TenderTypeID=3),
        payment(5, TenderTypeID=4), payment(6, TenderTypeID=None), payment(7)],
        PaymentProcessRequest=[{"PaymentProcessRequestId": 70, "TxPaymentID": 7}],
        PaymentProcessResponse=[{"PaymentProcessRequestId": 70, "ResponseCode": "A1"}],
        TxTransaction=[tx(100, 7)],
        Staging_ReportExclusionStaging=[
            {"ExclusionID": i, "ReportName": n, "Deleted": d, "Criteria": "TenderTypeID", "Value": v}
            for i, (n, d, v) in enumerate(listed)])
    assert ids(daily_pos(tables, now=NOW, tenant="tsi")) == [1, 5, 6]
    assert ids(daily_pos(tables, now=NOW, tenant="bfx")) == [1, 4, 6]
    assert ids(daily_pos(tables, now=NOW, tenant="tsi", payment_id=5)) == [5]
    assert ids(daily_pos(tables, now=NOW, tenant="tsi", member="M5")) == [1, 5, 6]
    assert ids(daily_pos(tables, now=NOW, tenant="tsi", member="M6")) == []
    assert ids(daily_batch(tables, now=NOW, tenant="tsi")) == []
    assert ids(daily_batch(tables, now=NOW, tenant="bfx")) == [7]
    assert ids(daily_batch(tables, now=NOW, tenant="bfx", transaction_code="70")) == [7]
    assert ids(daily_batch(tables, now=NOW, tenant="bfx", transaction_code=71)) == []


def test_pos_keeps_equal_rows_and_multiplies_repeats(billing):
    eft = {"TxPaymentId": 2, "Token": "t"}
    tables = billing(**BASE, TxPayment=[payment(1), payment(2), payment(3)],
                     TxTransaction=[tx(100, 1, 7), tx(101, 1, 7), tx(102, 2, 9), tx(103, 3, 5, kind=1)],
                     TxPaymentEft=[eft, eft])
    rows = daily_pos(tables, now=NOW, tenant="tsi").rows.collect()
    by_id = Counter((r.TxPaymentID, r.TransactionAmount and int(r.TransactionAmount)) for r in rows)
    # Two equal transactions stay two rows; repeated electronic rows double the amount; 3 has no payment transaction.
    assert by_id == {(1, 7): 2, (2, 18): 1, (3, None): 1}
    assert len({tuple(r) for r in rows if r.TxPaymentID == 1}) == 1
    row = rows[0]
    assert (row.MOSOPayTransactionCode, row.BatchID, row.Category, row.TransCode) == ("", "", "POS", "Payment")
    assert row.MerchantCode == "POS2"


def test_batch_adds_up_equal_transactions(billing):
    tables = billing(**BASE, TxPayment=[payment(1, IsDeclined=1), payment(2)],
                     TxTransaction=[tx(100, 1, 7), tx(101, 1, 7), tx(102, 1, 8), tx(103, 2, 5, invoice=77)],
                     PaymentProcessRequest=[{"PaymentProcessRequestId": 10 * i, "TxPaymentID": i, "PaymentProcessBatchId": 4} for i in (1, 2)],
                     PaymentProcessResponse=[{"PaymentProcessRequestId": 10, "ReferenceId": "r1", "ResponseCode": "a7"},
                                             {"PaymentProcessRequestId": 10, "ReferenceId": "r2", "ResponseCode": "D1"},
                                             {"PaymentProcessRequestId": 20, "ReferenceId": "r3"}])

    def shown(**options):
        rows = daily_batch(tables, now=NOW, tenant="tsi", **options).rows.collect()
        return sorted((r.ReferenceId, int(r.TransactionAmount), r.Chargeback_ind) for r in rows)

    # Payment 2 is on an unknown invoice.
    assert shown() == [("r1", 8, 1), ("r1", 14, 1), ("r2", 8, 0), ("r2", 14, 0)]
    assert shown(case_insensitive=False)[0] == ("r1", 8, 0)


@pytest.mark.parametrize("report", [daily_pos, daily_batch])
def test_windows_add_up(spark, sf_dir, report):
    tables = billing_tables(spark, sf_dir)
    marks = [datetime(1998, 1, 1), datetime(1998, 5, 17), datetime(1999, 1, 1)]

    def run(low, high):
        return Counter(tuple(r) for r in report(tables, now=NOW, tenant="tsi", current_mark=low, new_mark=high).rows.collect())

    whole = run(marks[0], marks[2])
    assert whole and whole == run(marks[0], marks[1]) + run(marks[1], marks[2])


def test_no_payment_is_in_both(spark, sf_dir):
    tables = billing_tables(spark, sf_dir)
    window = {"current_mark": datetime(1995, 1, 1), "new_mark": datetime(2002, 1, 1)}
    pos = daily_pos(tables, now=NOW, tenant="tsi", **window).rows.select("TxPaymentID")
    batch = daily_batch(tables, now=NOW, tenant="tsi", **window).rows.select("TxPaymentID")
    assert pos.count() and batch.count() and pos.intersect(batch).count() == 0
