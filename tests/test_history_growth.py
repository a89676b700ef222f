"""What the reports keep and shuffle does not grow with dates, statuses or the sizes at which a side is still broadcast."""

from datetime import datetime

from tallyhouse.plans.ar_history import ar_aging_history, overlaps, stretches
from tallyhouse.sinks.stages import StageArea
from tallyhouse.testbed.adapter import billing_tables

NOW = datetime(2001, 8, 2, 6)


class Counted(StageArea):
    """Stages that know how many rows they hold."""

    def __init__(self, spark):
        super().__init__(spark)
        self.rows = 0

    def keep(self, frame, name):
        kept = super().keep(frame, name)
        if name != "balance_events":  # at most one per ledger row
            self.rows += kept.count()
        return kept


def test_an_amount_that_stays_is_one_row_for_all_its_dates(spark):
    events = spark.sql("select * from values (1, 1, 0, 5), (1, 1, 3, -5), (1, 2, 1, 7) as t(invoice_id, line_no, k, due)")
    balance = spark.sql("select * from values (1, 0, 4), (1, 5, -4), (2, 0, 1) as t(invoice_id, k, balance)")
    found = overlaps(stretches(events, ["invoice_id", "line_no"], "due", 12), stretches(balance, ["invoice_id"], "balance", 12))
    assert sorted((r.invoice_id, r.line_no, r.from_k, r.to_k, int(r.due)) for r in found.collect()) == [(1, 1, 0, 2, 5), (1, 2, 1, 4, 7)]


def test_a_repeated_header_repeats_the_amount_and_not_the_row(spark):
    due = spark.sql("select * from values (1, 1, 0, 5, 5), (1, 2, 0, 0, 7) as t(invoice_id, line_no, from_k, to_k, due)")
    twice = spark.sql("select * from values (1, 'a', 0, 3), (1, 'b', 0, 3) as t(invoice_id, account_id, from_k, to_k)")
    assert sorted((r.line_no, r.from_k, r.to_k, int(r.due)) for r in overlaps(due, twice).collect()) == [(1, 0, 3, 10), (2, 0, 0, 14)]


def test_more_dates_keep_no_more_rows(spark, sf_dir):
    """After the ledger's last transaction nothing changes: dates there add rows to the report and none to its stages."""
    tables, kept, shown = billing_tables(spark, sf_dir), [], []
    for days in (1, 8):
        stages = Counted(spark)
        found = ar_aging_history(tables, dates=[datetime(2010, 1, 1 + day) for day in range(days)], now=NOW, stages=stages)
        kept.append(stages.rows)
        shown.append(found.count())
    assert shown[1] == 8 * shown[0] > 0 and kept[1] == kept[0]
