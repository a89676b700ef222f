"""Every registered query against its check in DuckDB."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry

# The add-on's queries are tested in its own folder.
QUERIES = {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}
CHECKS = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, con):
    frame = QUERIES[name](spark, sf_dir)
    assert differences(frame, con, CHECKS[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows
    for row in rows:
        buckets = [row.current, row.days_31_60, row.days_61_90, row.days_91_120, row.days_121_up]
        assert sum(buckets) == pytest.approx(row.total_due)


# Joins as on tables too large to broadcast, with partitions split at a few kilobytes.
_LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@pytest.mark.parametrize("name", [
    "report_daily_pos", "report_daily_batch", "report_net_members", "report_ar_aging", "report_unmatched", "report_unmatched_totals", "left_join_fanout", "enrich_update",
])
def test_query_with_shuffled_and_split_joins(name, spark, sf_dir, con):
    before = {key: spark.conf.get(key, None) for key in _LARGE}
    for key, value in _LARGE.items():
        spark.conf.set(key, value)
    try:
        frame = QUERIES[name](spark, sf_dir)
        assert differences(frame, con, CHECKS[name]) is None
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
