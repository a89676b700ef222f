"""The billing tables that Spark derives against those that the checks derive."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import differences

from tallyhouse.testbed.adapter import billing_tables, duckdb_select, spark_select

LINES = [(key, part, number, price, ship) for key, part, number, price, ship in [
    *[(key, 10 + key, number, 100.25 * number + key, datetime(1998, 1 + key % 12, number)) for key in range(1, 120) for number in range(1, 1 + key % 6)],
    (3, 7, 1, 5.5, datetime(1999, 1, 1)), (3, 7, 1, 5.5, datetime(1999, 1, 1)), (13, 1, 1, None, None), (13, 1, None, 8.0, datetime(1999, 1, 2)),
    (None, 5, 1, 3.0, datetime(1999, 1, 3)), (None, 5, 1, 4.0, datetime(1999, 1, 4)), (900, 2, 1, 1.0, datetime(1999, 1, 5)), (33, None, 2, 2.0, None),
]]
# Some orders come twice, with equal and with different states; one has no key and one no lines.
ORDERS = [*[(key, "FPO"[key % 3]) for key in range(1, 120)], (3, "F"), (6, "P"), (9, "P"), (13, "F"), (13, "F"), (14, None), (33, "P"), (None, "F"), (5000, "F")]


@pytest.fixture
def sources(spark, tmp_path):
    import duckdb

    lines = pa.table({name: pa.array(column, kind) for (name, kind), column in zip({
        "l_orderkey": pa.int64(), "l_partkey": pa.int64(), "l_linenumber": pa.int32(), "l_extendedprice": pa.float64(),
        "l_shipdate": pa.timestamp("us")}.items(), zip(*LINES, strict=True), strict=True)})
    orders = pa.table({"o_orderkey": pa.array([key for key, _ in ORDERS], pa.int64()), "o_orderstatus": [state for _, state in ORDERS]})
    con = duckdb.connect()
    for name, table in (("lineitem", lines), ("orders", orders)):
        pq.write_table(table, f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
    return {name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("lineitem", "orders")}, con


def test_the_ledger_has_the_rows_of_its_select(spark, sources):
    frames, con = sources
    assert differences(spark.sql(spark_select("TxTransaction"), **frames), con, duckdb_select("TxTransaction")) is None


def test_lines_are_dealt_out_once(spark, sources):
    frames, _ = sources
    plan = spark.sql(spark_select("TxTransaction"), **frames)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") and plan.count("Relation [l_orderkey") == 1 and plan.count("RepartitionByExpression [l_orderkey") == 1


def test_columns_keep_their_types(spark, sf_dir):
    ledger = billing_tables(spark, sf_dir)["TxTransaction"]
    assert [f.dataType.simpleString() for f in ledger.schema.fields if f.name in ("GroupId", "Amount", "TargetDate")] == ["int", "decimal(19,4)", "timestamp_ntz"]
