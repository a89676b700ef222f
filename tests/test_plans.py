"""What the physical plans must, and must not, contain."""

import re
from datetime import datetime

import pytest

import __spark_entry__ as entry
from tallyhouse.plans.ar_aging import line_ledger, open_invoices
from tallyhouse.testbed.adapter import billing_tables

QUERIES = {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}


def plan(frame):
    spark = frame.sparkSession
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_second_tenant")])
def test_no_cross_joins_no_python_and_no_forced_broadcasts(name, spark, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    text = plan(frame)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit", "SinglePartition"):
        if unwanted == "SinglePartition" and name == "row_counts":
            continue  # one global count, combined per task first
        assert unwanted not in text, unwanted
    assert "strategy=broadcast" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_anti_joins(spark, sf_dir):
    for name in ("unmatched_anti", "exclusion_anti", "report_unmatched"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "LeftAnti" in text and "ExistenceJoin" not in text


def test_top_one_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["first_sale_line"](spark, sf_dir))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange") > tree.index("WindowGroupLimit")


def test_latest_values_combine_before_the_shuffle(spark, sf_dir):
    tree = plan(QUERIES["min_date_per_key"](spark, sf_dir)).split("\n\n")[0]
    assert "Window" not in tree
    assert len(re.findall("Aggregate", tree)) >= 4


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["watermark_window"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)
    text = plan(QUERIES["point_in_time_join"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*LessThan\(l_shipdate", text)
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_ledger_is_dealt_out_once(spark, sf_dir):
    """Few open invoices are broadcast to the ledger; many meet it by one exchange on the invoice."""
    tables = billing_tables(spark, sf_dir)
    from tallyhouse.sinks.stages import StageArea

    invoices = StageArea(spark).keep(open_invoices(tables), "invoices")

    def tree():
        return plan(line_ledger(tables, invoices, datetime(2000, 1, 1))).split("\n\n")[0]

    assert "BroadcastHashJoin LeftSemi" in tree()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = tree()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    # One exchange of the ledger, one of the invoice ids.
    assert "Broadcast" not in many and len(re.findall(r"[+:]- Exchange|- Exchange", many)) == 2


def test_ledger_is_scanned_twice(spark, sf_dir):
    """Once for the balances and once for the open lines; each scan reads what it needs."""
    tables = billing_tables(spark, sf_dir)
    text = plan(open_invoices(tables))
    assert text.count("GroupId") == 0
    ledger = [m for m in re.findall(r"ReadSchema: (struct<.*>)", text) if "IsAccountingCredit" in m]
    assert ledger == ["struct<TxInvoiceId:bigint,Amount:decimal(19,4),IsAccountingCredit:int>"]
