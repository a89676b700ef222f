"""One row, or one set of values, per key.

Columns and sort terms are given as SQL text, for example ``"invoice_id desc"``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.joins import left_join_sparse, quoted

if TYPE_CHECKING:
    from tallyhouse.sinks.counts import RunCounts

_RANK = "__rank"


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each key to one row per task before the shuffle (a partial group
    limit), so a key holding a large share of the rows is not sorted in one task.
    """
    rank = F.expr(f"row_number() over (partition by {', '.join(keys)} order by {', '.join(order)})")
    return frame.withColumn(_RANK, rank).filter(f"{_RANK} = 1").drop(_RANK)


def latest_values(
    frame: DataFrame, keys: Sequence[str | Column], values: Mapping[str, str], by: str, when: str | None = None
) -> DataFrame:
    """Values of the row with the largest ``by`` per key, as an aggregate combined before the shuffle.

    ``values`` maps output names to columns. Only rows satisfying ``when`` count; a null
    value on the latest row stays null.
    """
    return frame.groupBy(*keys).agg(*latest_aggregates(values, by, when))


def latest_aggregates(values: Mapping[str, str], by: str, when: str | None = None) -> list[Column]:
    """The aggregates of :func:`latest_values`, so that several kinds share one pass."""
    rank = by if when is None else f"case when {when} then {by} end"
    return [F.expr(f"max_by({value}, {rank}) as {name}") for name, value in values.items()]


def enrich(
    frame: DataFrame, source: DataFrame, key: str, source_key: str, columns: Mapping[str, str],
    order: Sequence[str] | None = None, spread_by: Sequence[str] = (), counts: RunCounts | None = None, step: str = "",
) -> DataFrame:
    """Fill columns of ``frame`` from the matching row of ``source``.

    Rows without a match get nulls, and none is lost or repeated: with several matches
    the first in ``order`` wins. Pass no order when ``source`` has one row per key.
    Where the key is often null, ``spread_by`` names columns that tell rows apart, to
    spread the nulls by. ``counts`` learns under ``step`` how many rows found no match.
    """
    if order is not None:
        source = first_per_key(source, [source_key], order)
    picked = source.selectExpr(f"{source_key} as __key", *[f"{column} as {name}" for name, column in columns.items()])
    if counts is not None:
        picked = picked.withColumn("__found", F.lit(True))
    if spread_by:
        joined = left_join_sparse(frame, picked, key, "__key", spread_by)
    else:
        joined = frame.join(picked, F.expr(f"{key} = __key"), "left").drop("__key")
    if counts is None:
        return joined
    return counts.watch(joined, step, unmatched=F.count_if(F.col("__found").isNull())).drop("__found")


def wide_key_distinct(frame: DataFrame, keys: Sequence[str], output: Mapping[str, str]) -> DataFrame:
    """One row per distinct ``keys``, shown as ``output`` only: equal output rows may repeat."""
    distinct = frame.selectExpr(*quoted(keys)).distinct()
    return distinct.selectExpr(*[f"{expression} as `{name}`" for name, expression in output.items()])


def typed_insert(frame: DataFrame, schema: StructType) -> DataFrame:
    """Rows in the declared columns and types; columns the rows lack are null."""
    present = {name.lower() for name in frame.columns}
    return frame.selectExpr(*[
        f"cast({f'`{field.name}`' if field.name.lower() in present else 'null'} as {field.dataType.simpleString()})"
        f" as `{field.name}`"
        for field in schema.fields
    ])
