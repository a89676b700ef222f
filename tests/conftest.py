import os
import sys
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tallyhouse.session import tune  # noqa: E402
from tallyhouse.sinks.files import Files  # noqa: E402
from tallyhouse.sinks.stages import shared_folder, sweep  # noqa: E402
from tallyhouse.sources.schemas import SOURCE_DDL, canonical, declared  # noqa: E402
from tallyhouse.sources.tables import TableSet  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    # Whatever the queries kept is swept away with the application that made it.
    sweep(session, mine=True)
    own = session.sparkContext.getCheckpointDir() or ""  # Spark's own, which it removes itself
    left = [name for name in Files(session).names(shared_folder(session)) if name != own.rsplit("/", 1)[-1]]
    session.stop()
    assert left == []


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


# Hand-built rows are few: compiling and adapting their plans would take longer than running them.
_SMALL = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    "spark.sql.shuffle.partitions": "1",
}


@pytest.fixture
def small(spark):
    before = {key: spark.conf.get(key) for key in _SMALL}
    for key, value in _SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def billing(small):
    """Build a table set from a few rows per table; missing columns are null, missing tables empty."""

    def build(**rows) -> TableSet:
        given = {canonical(name): records for name, records in rows.items()}
        frames = {}
        for name in SOURCE_DDL:
            schema = declared(name)
            records = []
            for record in given.get(name, []):
                lower = {key.lower(): value for key, value in record.items()}
                unknown = set(lower) - {f.name.lower() for f in schema.fields}
                assert not unknown, (name, unknown)
                records.append({
                    f.name: Decimal(str(lower[f.name.lower()]))
                    if f.dataType.typeName() == "decimal" and lower.get(f.name.lower()) is not None
                    else lower.get(f.name.lower())
                    for f in schema.fields
                })
            # Through Arrow, so that the rows are part of the plan and their size is known.
            table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
            frames[name] = small.createDataFrame(table, schema)
        return TableSet.of(frames)

    return build
