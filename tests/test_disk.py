"""What the reports leave on disk: no shuffle files of stages, no stage that nothing reads any more, one exchange of the ledger."""

import re
from datetime import date, datetime

import pytest
from test_plans import plan

import __spark_entry__ as entry
from tallyhouse.plans.ar_aging import ar_aging
from tallyhouse.plans.ar_history import ar_aging_history
from tallyhouse.plans.ledger_snapshot import DayLedger, LedgerSnapshot
from tallyhouse.plans.unmatched import open_balances, unmatched_payments, unmatched_totals
from tallyhouse.sinks.files import Files
from tallyhouse.sinks.stages import FILE_CLEANUP, StageArea, tidy_writes
from tallyhouse.testbed import report_queries
from tallyhouse.testbed.adapter import billing_tables

SINCE, AS_OF, NOW = datetime(1998, 1, 1), datetime(2000, 1, 1), datetime(2001, 8, 2, 6)


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def left(spark, stages):
    return {name for name in Files(spark).names(stages.folder) if name[0] != "_"}


def test_a_stage_leaves_no_shuffle_files(spark):
    before, setting = shuffles(spark), spark.conf.get(FILE_CLEANUP)
    with StageArea(spark) as stages:
        kept = stages.keep(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counts")
        assert kept.count() == 7
    assert shuffles(spark) <= before + 1  # the count's own
    assert spark.conf.get(FILE_CLEANUP) == setting


def test_the_setting_comes_back_after_a_failure(spark):
    setting = spark.conf.get(FILE_CLEANUP)
    with pytest.raises(ValueError, match="stop"), tidy_writes(spark):
        raise ValueError("stop")
    assert spark.conf.get(FILE_CLEANUP) == setting


def test_a_stage_can_go_before_the_others(spark):
    with StageArea(spark) as stages:
        stages.keep(spark.range(3).toDF("a"), "first")
        second = stages.keep(spark.range(4).toDF("a"), "second")
        stages.drop("first")
        assert "first" not in Files(spark).names(stages.folder) and second.count() == 4


def test_totals_keep_nothing_of_the_ledger(spark, sf_dir):
    tables = billing_tables(spark, sf_dir)
    with StageArea(spark) as stages:
        since = unmatched_payments(tables, since=SINCE, ordered=False)
        assert unmatched_totals(tables, since, as_of=AS_OF, stages=stages).count() > 0
        assert left(spark, stages) == {"problem_amounts", "owed", "crowded_members"}


def test_balances_deal_the_ledger_out_once(spark, sf_dir, no_broadcasts):
    tables = billing_tables(spark, sf_dir)
    text = plan(open_balances(tables, tables["TxInvoice"].select("TxInvoiceID"), AS_OF)).split("\n\n")[0]
    assert len(re.findall("Scan parquet", text)) == 2 and len(re.findall(r"[+:]- Exchange", text)) == 2


def test_the_sql_function_reads_the_amounts_of_the_ledger_once(spark, sf_dir, no_broadcasts):
    text = plan(entry.queries()["sql_unmatched_totals"](spark, sf_dir))
    assert len([m for m in re.findall(r"ReadSchema: (struct<.*>)", text) if "IsAccountingCredit" in m]) == 1


def test_bucketed_tables_and_the_report_keep_what_is_still_read(spark, sf_dir):
    tables = report_queries.bucketed_tables(billing_tables(spark, sf_dir), buckets=2)
    assert all(".zstd" in file for file in tables["TxTransaction"].inputFiles())
    with StageArea(spark) as stages:
        assert ar_aging(tables, now=NOW, as_of=AS_OF, stages=stages).count() > 0
        assert left(spark, stages) == {"ledger", "owed"}


def test_a_report_from_a_snapshot_keeps_no_facts(spark, sf_dir, tmp_path):
    tables = billing_tables(spark, sf_dir)
    days, snapshot = DayLedger(spark, str(tmp_path / "days")), LedgerSnapshot(spark, str(tmp_path / "snapshot"))
    days.write_day(date(2000, 6, 1), tables["TxTransaction"])
    snapshot.advance(days.rows(), through=date(2000, 6, 1), cut=AS_OF)
    with StageArea(spark) as stages:
        view = snapshot.view(days.rows(), stages)
        assert all(".zstd" in file for file in [*days.rows().inputFiles(), *view.facts.inputFiles()])
        assert ar_aging(tables, now=NOW, as_of=AS_OF, stages=stages, snapshot=view).count() > 0
        assert left(spark, stages) == {"ledger", "owed"}


def test_many_dates_keep_amounts_and_owners_only(spark, sf_dir):
    with StageArea(spark) as stages:
        found = ar_aging_history(billing_tables(spark, sf_dir), dates=[AS_OF, NOW], now=NOW, stages=stages)
        assert found.count() > 0 and left(spark, stages) == {"amounts", "owed"}
