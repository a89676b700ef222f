"""Snapshots, many dates and buckets give what the whole ledger gives, and read less."""

import re
from datetime import date, datetime, timedelta

import pytest
from compare import bag
from test_plans import plan

from tallyhouse.plans.ar_aging import ar_aging, line_ledger, open_invoices
from tallyhouse.plans.ar_history import ar_aging_history
from tallyhouse.plans.ledger_snapshot import DayLedger, LedgerSnapshot
from tallyhouse.sinks.stages import NoStages, StageArea
from tallyhouse.sources.tables import TableSet, bucketed_by
from tallyhouse.testbed import report_queries
from tallyhouse.testbed.adapter import billing_tables

NOW, AS_OF = datetime(2024, 6, 1, 8), datetime(2024, 5, 1)
DAY = date(2024, 5, 2)


def rows(frame):
    return bag(frame.columns, [tuple(r) for r in frame.collect()])


def tx(key, invoice_id, line, amount, credit=0, at=datetime(2024, 4, 1), kind=1, item=None):
    return {"TxTransactionID": key, "TxInvoiceId": invoice_id, "GroupId": line, "ItemId": item, "TxTypeID": kind,
            "Amount": amount, "IsAccountingCredit": credit, "TargetDate": at}


def world(transactions, invoices):
    return {
        "TxInvoice": [{"TxInvoiceID": key, "PartyRoleId": 5, "TargetBusinessUnitId": 2, "TargetDate": datetime(2024, 3, 1),
                       "PaymentDueDate": None, "ClientAccountId": 7} for key in invoices],
        "TxTransaction": transactions,
        "PartyRole": [{"PartyRoleID": 5, "PartyID": 50, "RoleID": "M5", "PartyRoleTypeID": 1}],
        "ClientAccount": [{"ClientAccountId": 7, "IsExternal": 0}],
        "ClientAccountParty": [{"ClientAccountId": 7, "PartyId": 50, "PrimaryParty": 1}],
        "BusinessUnit": [{"BusinessUnitId": 2, "Name": "Unit", "GLCodePrefix": "U2", "DivisionId": 3}],
        "Division": [{"DivisionID": 3, "Name": "East"}],
    }


# By posting day: an invoice that is paid, one paid and reopened, one settled with a late row, one that is new, odd rows.
POSTED = {
    DAY: [tx(1, 1, 1, 100), tx(2, 2, 1, 50), tx(3, 2, 1, 50, credit=1, at=datetime(2024, 4, 20), kind=4, item=900), tx(4, 3, 1, 70),
          tx(5, 3, None, 5, at=None), tx(6, 4, 1, 30, at=datetime(2024, 5, 3)), tx(7, None, 1, 9), tx(8, 6, 1, 20),
          tx(9, 6, 1, 20, credit=1, at=datetime(2024, 5, 20), kind=4, item=903)],
    DAY + timedelta(days=1): [tx(10, 1, 1, 100, credit=1, at=datetime(2024, 5, 2), kind=4, item=901), tx(11, 2, 2, 25, item=77)],
    DAY + timedelta(days=2): [tx(12, 2, 2, 5, credit=1, at=datetime(2024, 4, 2), kind=4, item=902), tx(0, 3, 1, 1, credit=None)],
    DAY + timedelta(days=3): [tx(13, 5, 1, 40, at=datetime(2024, 4, 30, 23)), tx(14, 5, 2, 60, at=AS_OF)],
}
INVOICES = range(1, 7)


@pytest.fixture
def posted(billing, small, tmp_path):
    ledger = DayLedger(small, str(tmp_path / "days"))
    for day, transactions in POSTED.items():
        ledger.write_day(day, billing(TxTransaction=transactions)["TxTransaction"])
    everything = [t for transactions in POSTED.values() for t in transactions]
    return ledger, billing(**world(everything, INVOICES)), LedgerSnapshot(small, str(tmp_path / "snapshot"))


@pytest.mark.parametrize("point_in_time", [False, True])
@pytest.mark.parametrize("steps", [(0,), (0, 1, 2)])
def test_a_snapshot_with_the_days_since_equals_the_ledger(posted, small, steps, point_in_time):
    ledger, tables, snapshot = posted
    cuts = [datetime(2024, 4, 1), datetime(2024, 4, 10), datetime(2024, 4, 30), AS_OF]
    for cut, step in zip(cuts, steps, strict=False):
        assert snapshot.advance(ledger.rows(), through=DAY + timedelta(days=step), cut=cut)
    for as_of in (datetime(2024, 5, 2, 12), datetime(2024, 6, 1)) if point_in_time else (AS_OF,):
        whole = ar_aging(tables, now=NOW, as_of=as_of, point_in_time=point_in_time, stages=NoStages())
        view = snapshot.view(ledger.rows(), StageArea(small))
        assert rows(ar_aging(tables, now=NOW, as_of=as_of, point_in_time=point_in_time, stages=NoStages(), snapshot=view)) == rows(whole)
        assert whole.count() > 0


def test_a_snapshot_knows_its_limits(posted, small):
    ledger, _, snapshot = posted
    with pytest.raises(ValueError, match="no snapshot"):
        snapshot.view(ledger.rows(), StageArea(small))
    first = snapshot.advance(ledger.rows(), through=DAY, cut=AS_OF)
    assert snapshot.through() == DAY and snapshot.advance(ledger.rows(), through=DAY, cut=AS_OF).number == first.number
    with pytest.raises(ValueError, match="dates from"):
        snapshot.view(ledger.rows(), StageArea(small)).lines(datetime(2024, 4, 1))
    with pytest.raises(ValueError, match="cut"):
        snapshot.advance(ledger.rows(), through=DAY + timedelta(days=1), cut=datetime(2024, 1, 1))
    assert ledger.days() == list(POSTED)
    # A day written again replaces itself.
    ledger.write_day(DAY, ledger.rows().filter("posted = date'2024-05-05'").drop("posted"))
    assert ledger.rows().filter(f"posted = date'{DAY}'").count() == 2


def test_a_view_reads_the_snapshot_and_the_days_since(posted, small):
    ledger, _, snapshot = posted
    snapshot.advance(ledger.rows(), through=DAY + timedelta(days=1), cut=AS_OF)
    view = snapshot.view(ledger.rows(), NoStages())
    found = view.lines(AS_OF)
    read = {re.search(r"(posted=[\d-]+|is_open=\w+)", file)[0] for file in found.inputFiles()}
    assert f"posted={DAY}" not in plan(found) and re.search(r"PartitionFilters: \[isnotnull\(posted#\d+\), \(posted#\d+ > 2024-05-03\)\]", plan(found))
    assert {"posted=2024-05-04", "posted=2024-05-05"} <= read or "is_open=true" in read


def test_many_dates_at_once_equal_single_runs(spark, sf_dir):
    tables = billing_tables(spark, sf_dir)
    dates = report_queries.MONTH_ENDS[2:4]
    found = rows(ar_aging_history(tables, dates=dates, now=NOW))
    singles = [ar_aging(tables, now=NOW, as_of=at, point_in_time=True) for at in dates]
    union = singles[0]
    for single in singles[1:]:
        union = union.unionByName(single)
    assert rows(union) == found and sum(found[1].values()) > 100


def test_many_dates_on_hand_built_rows(billing, small):
    everything = [t for transactions in POSTED.values() for t in transactions]
    tables = billing(**world(everything, INVOICES))
    dates = [datetime(2024, 4, 21), AS_OF, datetime(2024, 5, 2, 12)]
    found = ar_aging_history(tables, dates=[*dates, AS_OF], now=NOW, stages=NoStages())
    union = None
    for at in dates:
        single = ar_aging(tables, now=NOW, as_of=at, point_in_time=True, stages=NoStages())
        union = single if union is None else union.unionByName(single)
    assert rows(found) == rows(union)
    with pytest.raises(ValueError, match="at least one"):
        ar_aging_history(tables, dates=[], now=NOW)


def test_many_dates_scan_the_ledger_once(spark, sf_dir):
    from tallyhouse.plans.ar_history import balance_events

    text = plan(balance_events(billing_tables(spark, sf_dir), report_queries.MONTH_ENDS))
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1 and len(re.findall(r"[+:]- Exchange", text.split("\n\n")[0])) == 1


def test_buckets_leave_the_ledger_where_it_lies(spark, sf_dir):
    """With broadcasts off, nothing of the ledger is shuffled: only the kept invoices are."""
    plain = billing_tables(spark, sf_dir)
    tables = report_queries.bucketed_tables(plain, buckets=4)
    assert bucketed_by(tables, "TxTransaction", "TxInvoiceId") and not bucketed_by(plain, "TxTransaction", "TxInvoiceId")
    assert isinstance(tables, TableSet) and not bucketed_by(tables, "TxPayment", "TxPaymentID")
    invoices = StageArea(spark).keep(open_invoices(tables), "invoices")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(line_ledger(tables, invoices, AS_OF)).split("\n\n")[0]
        balances = plan(open_invoices(tables)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The one exchange is of the invoices' ids.
    assert len(re.findall(r"[+:]- Exchange", lines)) == 1 and lines.index("Exchange") > lines.index("Aggregate")
    assert "Exchange" not in lines[: lines.index("Scan parquet")]
    # Balances and headers meet in their buckets; only the meeting with members is dealt out.
    ledger_side = balances[balances.index("Aggregate"):]
    assert "Exchange" not in ledger_side[: ledger_side.index("Scan parquet")]
