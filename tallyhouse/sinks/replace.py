"""Full replacement of a report table, guarded against an empty run, a changed schema and a second writer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.sinks.counts import RunCounts
from tallyhouse.sinks.generations import Generation, Generations
from tallyhouse.sinks.layout import sorted_files

GENERATIONS_KEPT = 2


def schema_difference(report: StructType, table: StructType) -> str:
    """What differs by column name and type, empty if nothing does; the order does not matter."""
    ours, theirs = ({field.name: field.dataType.simpleString() for field in schema.fields} for schema in (report, table))
    return "; ".join(
        f"{name}: {theirs.get(name, 'missing')} in the table, {ours.get(name, 'missing')} in the report"
        for name in sorted(ours.keys() | theirs.keys()) if ours.get(name) != theirs.get(name)
    )


@dataclass(frozen=True)
class Replacement:
    """What a run did: true if the table has its rows now. ``lost`` tells that another run published first."""

    replaced: bool
    rows: int = 0
    number: int | None = None
    lost: bool = False
    counts: Mapping[str, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return self.replaced


def point_to_latest(spark: SparkSession, table: str, generations: Generations, schema: StructType | None = None) -> Generation | None:
    """Let the catalog's table read the latest generation, creating it if need be.

    Mends a run that died between publishing and this step. Looks again afterwards, so that of several runs the last to look
    leaves the latest generation behind.
    """
    pointed = None
    while (latest := generations.latest()) is not None and latest != pointed:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{latest.folder}'")
            spark.catalog.refreshTable(table)
        else:
            found = schema or generations.read(latest).schema
            spark.catalog.createTable(table, path=latest.folder, source="parquet", schema=found)
        pointed = latest
    return pointed


def replace_if_nonempty(
    report: DataFrame, table: str, root: str, *, dry_run: bool = False, based_on: int | None = None, keep: int = GENERATIONS_KEPT,
    order: Sequence[str | Column] = (), counts: RunCounts | None = None,
) -> Replacement:
    """Make ``report`` the whole content of ``table``; keep the old content if there are no rows.

    The rows are written as an attempt below ``root`` first and counted as they are written. Only when there are some, and no other
    run has published since ``based_on`` (the latest generation when this is called, unless given), do they become
    the next generation, by one atomic rename; the catalog's table is pointed to it after that. A reader sees all
    old or all new rows, and a run that fails changes nothing. The last ``keep`` generations stay, so that readers of
    the one before can finish; older ones and the remains of dead runs go.

    A report whose columns differ from the table's in name or type raises ``ValueError`` before anything is written. With
    ``dry_run`` nothing is written: read ``report`` instead. ``order`` writes the rows as files in that order.
    ``counts`` holds what the report's steps counted on the way; they are returned with the number of rows.
    """
    if dry_run:
        return Replacement(False)
    spark = report.sparkSession
    generations = Generations(spark, root)
    base = generations.latest_number() if based_on is None else based_on
    point_to_latest(spark, table, generations)
    if spark.catalog.tableExists(table) and (difference := schema_difference(report.schema, spark.table(table).schema)):
        raise ValueError(f"{table} keeps its content, since the report has other columns: {difference}")
    counts = counts or RunCounts()
    folder = generations.attempt()
    counts.watch(report, "report", rows=F.count("*")).write.mode("errorifexists").parquet(folder)
    totals = counts.totals()
    rows = totals["report.rows"]
    if rows and order:
        # Finding the ranges reads the rows once more: the written ones, so that the report runs once and is counted once.
        unordered, folder = folder, generations.attempt()
        sorted_files(spark.read.schema(report.schema).parquet(unordered), order).write.mode("errorifexists").parquet(folder)
        generations.discard(unordered)
    if not rows:
        generations.discard(folder)
        return Replacement(False, counts=totals)
    published = generations.commit(base, folder, {"rows": rows})
    if published is None:
        generations.discard(folder)
        return Replacement(False, rows, lost=True, counts=totals)
    point_to_latest(spark, table, generations, report.schema)
    generations.sweep(keep)
    return Replacement(True, rows, published.number, counts=totals)
