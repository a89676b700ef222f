"""The full reports over the adapter tables, with fixed parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import AGING_NAMES
from tallyhouse.plans.ar_aging import ar_aging
from tallyhouse.plans.ar_history import ar_aging_history
from tallyhouse.plans.daily_payments import daily_batch, daily_pos
from tallyhouse.plans.endpoints import endpoint_listing
from tallyhouse.plans.ledger_snapshot import DayLedger, LedgerSnapshot
from tallyhouse.plans.net_members import net_member_count
from tallyhouse.plans.sql_functions import register
from tallyhouse.plans.unmatched import unmatched_payments, unmatched_totals
from tallyhouse.sinks.counts import RunCounts
from tallyhouse.sinks.layout import BUCKET_KEYS, write_bucketed
from tallyhouse.sinks.replace import replace_if_nonempty
from tallyhouse.sinks.stages import StageArea, owned_folder
from tallyhouse.sources.tables import TableSet
from tallyhouse.streaming import Extract, ExtractLog
from tallyhouse.testbed.adapter import billing_tables

NOW = datetime(2001, 8, 2, 6)
AS_OF = datetime(2000, 1, 1)
WINDOW = {"current_mark": datetime(1998, 1, 1), "new_mark": datetime(1999, 1, 1)}
SINCE = datetime(1998, 1, 1)


def _totals(tables: TableSet) -> DataFrame:
    return unmatched_totals(tables, unmatched_payments(tables, since=SINCE, ordered=False), as_of=AS_OF)


def _replaced(report: Callable[..., DataFrame]) -> Callable[[TableSet], DataFrame]:
    """A real report written as a table twice, the second time over the first, and read back."""
    def query(tables: TableSet) -> DataFrame:
        spark = tables["TxTransaction"].sparkSession
        root = owned_folder(spark, "reports")
        table = f"tallyhouse_{root.rsplit('-', 1)[1]}"
        for _ in range(2):
            with StageArea(spark) as stages:
                replace_if_nonempty(report(tables, stages), table, root)
        return spark.table(table)

    return query


def _counted(tables: TableSet) -> DataFrame:
    """What the writing pass of the member count counted: rows written, rows that exclusions left, rows without a user."""
    spark = tables["MemberAgreement"].sparkSession
    counts, root = RunCounts(), owned_folder(spark, "reports")
    with StageArea(spark) as stages:
        report = net_member_count(tables, now=NOW, stages=stages, counts=counts)
        done = replace_if_nonempty(report, f"tallyhouse_{root.rsplit('-', 1)[1]}", root, counts=counts)
    measures, values = zip(*sorted(done.counts.items()), strict=True)
    return spark.createDataFrame(pa.table({"measure": pa.array(measures, pa.string()), "value": pa.array(values, pa.int64())}))


def _ordered(tables: TableSet) -> DataFrame:
    """Unmatched payments written as files in order, latest first, with each row's place in its file."""
    spark = tables["TxPayment"].sparkSession
    root = owned_folder(spark, "reports")
    table = f"tallyhouse_{root.rsplit('-', 1)[1]}"
    rows = unmatched_payments(tables, since=SINCE, ordered=False)
    replace_if_nonempty(rows, table, root, order=[F.desc("TargetDate"), F.asc("TxPaymentID"), F.asc("ResponseCode")])
    return spark.table(table)


def _two_databases(tables: TableSet) -> DataFrame:
    """Payments of one database with the card types of another, read through a catalog."""
    spark = tables["TxPayment"].sparkSession
    folder, run = owned_folder(spark, "databases"), uuid.uuid4().hex[:8]
    for database, name in ((f"tenant_{run}", "TxPayment"), (f"meta_{run}", "CreditCardType")):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/{database}.db'")
        tables[name].write.saveAsTable(f"{database}.{name}")
    both = TableSet.catalog(spark, f"tenant_{run}", {"CreditCardType": f"meta_{run}.CreditCardType"})
    cards = both["CreditCardType"].selectExpr("CreditCardTypeID as card", "Description as card_name")
    return both["TxPayment"].join(cards, F.expr("CreditCardTypeId = card"), "left").groupBy("card_name").agg(
        F.count("*").alias("payments"), F.min("TargetDate").alias("first_date"))


def bucketed_tables(tables: TableSet, buckets: int = 8) -> TableSet:
    """The same tables with the large ones in buckets, in a database of their own."""
    spark = tables["TxTransaction"].sparkSession
    database = f"bucketed_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{owned_folder(spark, 'databases')}/{database}.db'")
    write_bucketed(tables, database, buckets)
    dealt = TableSet.catalog(spark, database)
    return TableSet(lambda name: dealt[name] if name in BUCKET_KEYS else tables[name], bucket_key=lambda name: (
        dealt.bucket_key(name) if name in BUCKET_KEYS else None))


# Rows are posted in an order that does not follow their dates: most with the first day, the rest on three days after it.
FIRST_DAY = date(2000, 6, 1)
_POSTED_AFTER = "case when TxTransactionID % 7 = 3 then 1 + cast(TxTransactionID div 7 % 3 as int) else 0 end"


def day_ledger(tables: TableSet) -> DayLedger:
    spark = tables["TxTransaction"].sparkSession
    ledger = DayLedger(spark, f"{owned_folder(spark, 'ledger')}/days")
    posted = tables["TxTransaction"].withColumn("__after", F.expr(_POSTED_AFTER))
    for days in range(4):
        ledger.write_day(FIRST_DAY + timedelta(days=days), posted.filter(F.col("__after") == days).drop("__after"))
    return ledger


def _snapshot_aging(tables: TableSet, **options: object) -> DataFrame:
    """The aging report from a snapshot of the first two posting days and the two days since, without the ledger."""
    spark = tables["TxTransaction"].sparkSession
    days = day_ledger(tables).rows()
    snapshot = LedgerSnapshot(spark, owned_folder(spark, "snapshot"))
    cut = datetime(1999, 6, 1)
    snapshot.advance(days, through=FIRST_DAY, cut=cut)
    snapshot.advance(days, through=FIRST_DAY + timedelta(days=1), cut=AS_OF)
    stages = StageArea(spark)
    view = snapshot.view(days, stages)
    without = TableSet(lambda name: _never(name) if name == "TxTransaction" else tables[name])
    return ar_aging(without, now=NOW, as_of=AS_OF, stages=stages, snapshot=view, **options)


def _never(name: str) -> DataFrame:
    raise AssertionError(f"{name} is not to be read")


def _extract_log(tables: TableSet) -> DataFrame:
    """The daily extract of a year as three committed windows, one of them run twice, read back as one."""
    spark = tables["TxPayment"].sparkSession
    log = ExtractLog(spark, owned_folder(spark, "extracts"))

    def source(low: datetime, high: datetime) -> Extract:
        return daily_pos(tables, now=NOW, tenant="tsi", current_mark=low, new_mark=high)

    bounds = [WINDOW["current_mark"], datetime(1998, 5, 1), datetime(1998, 10, 1), WINDOW["new_mark"]]
    for low, high in pairwise(bounds):
        log.run(source, now=NOW, low=low, high=high)
    log.run(source, now=NOW, low=bounds[1], high=bounds[2])
    return log.rows().drop("window_start")


def _sql_function(call: str) -> Callable[[TableSet], DataFrame]:
    def query(tables: TableSet) -> DataFrame:
        spark = tables["TxTransaction"].sparkSession
        prefix = f"f{uuid.uuid4().hex[:8]}_"
        register(spark, tables, prefix)
        return spark.sql(f"select * from {prefix}{call}")

    return query


def _months(tables: TableSet) -> DataFrame:
    """Twelve month ends of the aging report in one pass, added up per date and division."""
    report = ar_aging_history(tables, dates=MONTH_ENDS, now=NOW)
    amounts = [F.sum(name).alias(name) for name in (*AGING_NAMES, "TotalDue")]
    return report.groupBy("ReportDate", "Division").agg(F.count("*").alias("lines"), *amounts)


MONTH_ENDS = [datetime(1999 + (month - 1) // 12, (month - 1) % 12 + 1, 1) for month in range(2, 14)]

REPORTS: dict[str, Callable[[TableSet], DataFrame]] = {
    "report_endpoints": endpoint_listing,
    "report_daily_pos": lambda t: daily_pos(t, now=NOW, tenant="tsi", **WINDOW).rows,
    "report_daily_pos_second_tenant": lambda t: daily_pos(t, now=NOW, tenant="bfx", **WINDOW).rows,
    "report_daily_batch": lambda t: daily_batch(t, now=NOW, tenant="tsi", **WINDOW).rows,
    "report_daily_batch_second_tenant": lambda t: daily_batch(t, now=NOW, tenant="bfx", **WINDOW).rows,
    "report_ar_aging": lambda t: ar_aging(t, now=NOW, as_of=AS_OF),
    "report_net_members": lambda t: net_member_count(t, now=NOW),
    "report_unmatched": lambda t: unmatched_payments(t, since=SINCE),
    "report_unmatched_totals": _totals,
    "replace_ar_aging": _replaced(lambda t, stages: ar_aging(t, now=NOW, as_of=AS_OF, stages=stages)),
    "replace_net_members": _replaced(lambda t, stages: net_member_count(t, now=NOW, stages=stages)),
    "two_databases": _two_databases,
    "report_ar_aging_snapshot": _snapshot_aging,
    "report_ar_aging_months": _months,
    "report_ar_aging_bucketed": lambda t: ar_aging(bucketed_tables(t), now=NOW, as_of=AS_OF),
    "extract_log_daily_pos": _extract_log,
    "replacement_counts": _counted,
    "ordered_unmatched": _ordered,
    "sql_endpoints": _sql_function("endpoint_listing()"),
    "sql_unmatched": _sql_function("unmatched_payments(timestamp_ntz'1998-01-01 00:00:00')"),
    "sql_unmatched_totals": _sql_function(
        "unmatched_totals(since => timestamp_ntz'1998-01-01 00:00:00', as_of => timestamp_ntz'2000-01-01 00:00:00')"),
}


def report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(report: Callable[[TableSet], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: report(billing_tables(spark, sf_dir))

    return {name: bound(report) for name, report in REPORTS.items()}
