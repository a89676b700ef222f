import pytest

from tallyhouse.plans.endpoints import endpoint_listing
from tallyhouse.sinks import StageArea, replace_if_nonempty
from tallyhouse.sinks.stages import shared_folder
from tallyhouse.sources.schemas import SOURCE_DDL, declared
from tallyhouse.sources.tables import TableSet, repeated_keys


def values(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_replace_keeps_old_rows_when_empty(spark, tmp_path):
    table, root = "report_guard", str(tmp_path)
    first, second = spark.range(3), spark.range(10, 12)
    assert not replace_if_nonempty(first.limit(0), table, root)
    assert not spark.catalog.tableExists(table)
    assert replace_if_nonempty(first, table, root)
    assert values(spark.table(table)) == [(0,), (1,), (2,)]
    assert not replace_if_nonempty(second.limit(0), table, root)
    assert not replace_if_nonempty(second, table, root, dry_run=True)
    assert values(spark.table(table)) == [(0,), (1,), (2,)]
    assert replace_if_nonempty(second, table, root)
    assert values(spark.table(table)) == [(10,), (11,)]
    # A report may read the table it replaces.
    assert replace_if_nonempty(spark.table(table).selectExpr("id + 1 as id"), table, root)
    assert values(spark.table(table)) == [(11,), (12,)]
    spark.sql(f"DROP TABLE {table}")


def test_a_failed_run_changes_nothing(spark, tmp_path):
    table = "report_failed"
    assert replace_if_nonempty(spark.range(2), table, str(tmp_path))
    with pytest.raises(Exception, match="(?i)zero"):
        replace_if_nonempty(spark.range(3).selectExpr("id div (id - 1) as id"), table, str(tmp_path))
    assert values(spark.table(table)) == [(0,), (1,)]
    spark.sql(f"DROP TABLE {table}")


def test_stages_use_the_shared_folder(spark):
    area = StageArea(spark)
    kept = area.keep(spark.range(5).selectExpr("id", "'x' as `First Name`"), "numbers")
    assert area.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert kept.count() == 5 and kept.columns == ["id", "First Name"]
    assert "Range" not in kept._jdf.queryExecution().toString()
    assert StageArea(spark).folder != area.folder
    with pytest.raises(Exception, match="(?i)exists"):
        area.keep(spark.range(1), "numbers")


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, **settings):
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    class Context:
        def __init__(self, folder):
            self.getCheckpointDir = lambda: folder

    class Session:
        def __init__(self, folder=None, **settings):
            self.conf, self.sparkContext = Conf(**settings), Context(folder)

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_folder(Session())
    assert shared_folder(Session("file:/a/b")) == "file:/a/b"
    assert shared_folder(Session(**{"spark.checkpoint.dir": "hdfs:/c/"})) == "hdfs:/c"


def test_a_run_removes_its_stages(spark):
    from pathlib import Path

    with StageArea(spark) as area:
        area.keep(spark.range(3), "numbers")
        folder = Path(area.folder.removeprefix("file:"))
        assert folder.exists()
    assert not folder.exists()


@pytest.mark.parametrize("change", ["id, 1 as b", "1 as b", "cast(id as string) as id"])
def test_a_changed_schema_keeps_the_old_content(spark, tmp_path, change):
    table, root = "report_schema", str(tmp_path)
    assert replace_if_nonempty(spark.range(2), table, root)
    with pytest.raises(ValueError, match="keeps its content"):
        replace_if_nonempty(spark.range(9).selectExpr(*change.split(", ")), table, root)
    assert values(spark.table(table)) == [(0,), (1,)]
    spark.sql(f"DROP TABLE {table}")


def test_zoned_times_do_not_follow_the_session(spark):
    zoned = spark.sql("select 1 as TxPaymentID, timestamp'2024-01-10 02:00:00+00:00' as TargetDate")
    before = spark.conf.get("spark.sql.session.timeZone")
    names = [f.name for f in declared("TxPayment").fields if f.name not in ("TxPaymentID", "TargetDate")]
    frame = zoned.selectExpr("*", *[f"null as `{name}`" for name in names])
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            found = [str(TableSet.of({"TxPayment": frame}, zone)["TxPayment"].first().TargetDate) for zone in ("UTC", "Asia/Tokyo")]
            assert found == ["2024-01-10 02:00:00", "2024-01-10 11:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tables_conform(spark, tmp_path):
    spark.createDataFrame([(1, "7", "extra")], "workroleid int, NAME string, other string").write.parquet(f"{tmp_path}/WorkRole")
    spark.createDataFrame([(1, "a")], "PartyID int, `First Name` string").selectExpr(
        "PartyID", "`First Name`", "'b' as `last name`").write.parquet(f"{tmp_path}/PartyPropertiesReportingView")
    tables = TableSet.parquet(spark, str(tmp_path))
    assert tables["workrole"].dtypes == [("WorkRoleID", "bigint"), ("Name", "string")]
    assert tables["PARTYPROPERTIESREPORTINGVIEW"].columns == ["PartyID", "First Name", "Last Name"]
    assert len(tables) == len(SOURCE_DDL) == 46
    with pytest.raises(KeyError):
        tables["nothing"]


def test_tables_from_several_databases(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tenant")
    spark.sql("CREATE DATABASE IF NOT EXISTS meta")
    try:
        spark.createDataFrame([(1, "East")], "DivisionID bigint, Name string").write.saveAsTable("tenant.Division")
        spark.createDataFrame([(1, "NY")], "StateProvinceID bigint, Name string").write.saveAsTable("meta.states")
        tables = TableSet.catalog(spark, "tenant", {"StateProvince": "meta.states"})
        assert values(tables["Division"]) == [(1, "East")]
        assert values(tables["StateProvince"]) == [(1, "NY")]
    finally:
        spark.sql("DROP DATABASE tenant CASCADE")
        spark.sql("DROP DATABASE meta CASCADE")


def test_repeated_keys(billing):
    tables = billing(Division=[{"DivisionID": 1}, {"DivisionID": 1}, {"DivisionID": 2}])
    assert values(repeated_keys(tables, "division")) == [(1, 2)]


def test_endpoint_passes_all_columns(billing, small):
    given = {"EndpointID": "bigint", "BusinessUnitID": "bigint", "Serial Number": "string"}
    endpoints = small.createDataFrame(
        [(1, 2, "s1"), (2, 1, "s2"), (3, 1, "s3"), (4, 9, "s4")], ", ".join(f"`{n}` {t}" for n, t in given.items()))
    base = billing(
        BusinessUnit=[{"BusinessUnitId": i, "Name": f"U{i}"} for i in (1, 2)],
        EndpointSecurity=[{"EndpointID": e, "WorkRoleID": r} for e, r in ((1, 5), (2, 5), (2, 6), (2, 7), (4, 5))],
        WorkRole=[{"WorkRoleID": i, "Name": f"W{i}"} for i in (5, 6)],
        EndpointAccessType=[{"EndpointId": e} for e in (2, 2, None)])
    tables = TableSet.of({**{name: base[name] for name in base}, "Endpoint": endpoints})
    listing = endpoint_listing(tables)
    assert listing.columns == ["EndpointID", "BusinessUnitID", "Serial Number", "BUName", "Access", "WorkRole"]
    rows = [tuple(r) for r in listing.collect()]
    assert sorted(rows) == [(1, 2, "s1", "U2", 0, "W5"), (2, 1, "s2", "U1", 2, "W5"), (2, 1, "s2", "U1", 2, "W6")]
    assert [r[1] for r in rows] == [1, 1, 2]
