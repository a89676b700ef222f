from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.fixed_values import AGING_EDGES
from tallyhouse.operators import (
    aging_buckets, count_matches, credit_negative, credit_positive, enrich, exclude, first_per_key, latest_values,
    left_join_many, left_join_sparse, nonzero_sum, restrict_to_keys, typed_insert, unmatched, wide_key_distinct,
)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_missing_flag_counts_down_in_both_conventions(spark):
    frame = spark.createDataFrame([(1, 1, 10), (2, 0, 10), (3, None, 10)], "k int, flag int, amount int")
    shown = frame.select("k", credit_positive(F.col("flag"), F.col("amount")), credit_negative(F.col("flag"), F.col("amount")))
    assert rows(shown) == [(1, 10, -10), (2, -10, 10), (3, -10, -10)]


def test_nonzero_sum_drops_settled_and_unknown(spark):
    frame = spark.createDataFrame([(1, 5), (1, -5), (2, 7), (3, None)], "k int, v int")
    assert rows(nonzero_sum(frame, ["k"], F.col("v"), "total")) == [(2, 7)]


def test_aging_edges(spark):
    ages = [-1, 29, 30, 31, 60, 61, 90, 91, 120, 121, None]
    frame = spark.createDataFrame([(a,) for a in ages], "age int").withColumn("amount", F.lit(1))
    sums = [f"sum({sql}) as b{i}" for i, sql in enumerate(aging_buckets("age", "amount", AGING_EDGES))]
    assert tuple(frame.selectExpr(*sums).first()) == (3, 2, 2, 2, 1)


def test_first_per_key_ties_and_nulls(spark):
    frame = spark.createDataFrame(
        [(1, None, "a"), (1, 1, "b"), (2, 2, "d"), (2, 2, "c")], "k int, seq int, name string")
    assert rows(first_per_key(frame, ["k"], ["seq asc nulls first", "name"])) == [(1, None, "a"), (2, 2, "c")]
    assert rows(first_per_key(frame, ["k"], ["seq desc nulls last", "name"])) == [(1, 1, "b"), (2, 2, "c")]


def test_latest_values_keeps_a_null_on_the_latest_row(spark):
    frame = spark.createDataFrame([(1, 1, "old"), (1, 2, None), (2, 1, "x"), (3, 1, "skip")], "k int, id int, v string")
    latest = latest_values(frame, ["k"], {"v": "v"}, "id", when="k < 3")
    assert rows(latest) == [(1, None), (2, "x"), (3, None)]


def test_enrich_neither_loses_nor_repeats(spark):
    frame = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 10)], "id int, key int")
    source = spark.createDataFrame([(10, "a", 1), (10, "b", 2), (11, "c", 3)], "k int, v string, rank int")
    for spread in ((), ("id",)):
        found = enrich(frame, source, "key", "k", {"v": "v"}, order=["rank desc"], spread_by=spread)
        assert rows(found) == [(1, 10, "b"), (2, None, None), (3, 99, None), (4, 10, "b")]


def test_left_join_sparse_fans_out(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id int, key int")
    right = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "k int, v string")
    assert rows(left_join_sparse(left, right, "key", "k", ["id"])) == [
        (1, None, None), (2, 5, "x"), (2, 5, "y"), (3, None, None)]


def test_left_join_many_is_a_left_join(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 6), (4, 5)], "id int, key int")
    right = spark.createDataFrame([(5, "x"), (5, "x"), (5, "y"), (None, "z"), (7, "w")], "k int, v string")
    plain = left.join(right, left.key == right.k, "left").drop("k")
    assert rows(left_join_many(left, right, "key", "k")) == rows(plain)


def test_null_keys_are_spread_over_shuffle_groups(spark):
    left = spark.range(10_000).selectExpr("id", "cast(null as bigint) as key")
    right = spark.range(10).selectExpr("id as k", "id as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_sparse(left, right, "key", "k", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 4_000


def test_restrict_and_unmatched_split_the_rows(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(restrict_to_keys(frame, "k", keys)) == [(1,)]
    assert rows(unmatched(frame, keys, "k", "k")) == [(2,), (None,)]


def test_exclude(spark):
    listed = spark.createDataFrame(
        [(1, "r", 0, "Bundle", "2"), (2, "r", 0, "Bundle", "2"), (3, "r", 1, "Bundle", "3"), (4, "other", 0, "Bundle", "4"),
         (5, "r", 0, "Plan", "5"), (6, "r", 0, "Bundle", "n/a"), (7, "r", 0, "Bundle", None)],
        "ExclusionID bigint, ReportName string, Deleted int, Criteria string, Value string")
    frame = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, None)], "id int")
    assert rows(exclude(frame, listed, "r", {"Bundle": "id"})) == [(1,), (3,), (4,), (5,), (None,)]
    assert rows(exclude(frame, listed, "r", {"Bundle": "id", "Plan": "id"})) == [(1,), (3,), (4,), (None,)]


def test_count_matches_counts_none_as_zero(spark):
    frame = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "k2 int")
    assert rows(count_matches(frame, other, "k", "k2", "n")) == [(1, 2), (2, 0)]


def test_wide_keys_keep_equal_output_rows(spark):
    frame = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "id int, v string")
    assert rows(wide_key_distinct(frame, ["id", "v"], {"shown": "v"})) == [("x",), ("x",)]


def test_typed_insert_rounds_and_fills(spark):
    schema = StructType.fromDDL("id bigint, price decimal(12,2), at timestamp_ntz, note string")
    frame = spark.createDataFrame([(1, Decimal("2.3450"))], "ID int, price decimal(19,4)")
    inserted = typed_insert(frame, schema)
    assert [f.dataType for f in inserted.schema] == [f.dataType for f in schema]
    assert rows(inserted) == [(1, Decimal("2.35"), None, None)]


def test_sum_over_its_own_key_multiplies(spark):
    frame = spark.createDataFrame([(1, 5), (1, 5), (1, 7)], "k int, v int")
    assert rows(frame.groupBy("k", "v").agg(F.sum("v"))) == [(1, 5, 10), (1, 7, 7)]


def test_max_by_moment(spark):
    frame = spark.createDataFrame([(1, 1, datetime(2024, 1, 1)), (1, 2, datetime(2023, 1, 1))], "k int, id int, at timestamp_ntz")
    assert rows(latest_values(frame, ["k"], {"at": "at"}, "id")) == [(1, datetime(2023, 1, 1))]
