"""Join shapes of the reports.

No side is forced to be broadcast. Catalyst and AQE broadcast a side when its known
size is under the session's threshold and shuffle both otherwise; hot keys of
shuffled joins are split by AQE.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tallyhouse.sinks.counts import RunCounts


def quoted(names: Iterable[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def left_join_sparse(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: Sequence[str]
) -> DataFrame:
    """Left join on a key that is often null on the left; the right key is not returned.

    Null keys match nothing, yet would all be shuffled to one task. They are spread by
    a hash of ``spread_by``, columns that tell rows apart; it is the same on every retry.
    """
    row_hash = f"xxhash64({', '.join(quoted(spread_by))})"
    spread = F.expr(f"case when {left_key} is null then {row_hash} else 0 end")
    keyed = left.withColumn("__spread", spread)
    other = right.withColumnRenamed(right_key, "__match").withColumn("__at", F.lit(0).cast("long"))
    on = F.expr(f"{left_key} = __match and __spread = __at")
    return keyed.join(other, on, "left").drop("__spread", "__match", "__at")


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join whose right side may repeat one key without bound; the right key is not returned.

    A left outer join cannot split a hot key of its right side over several tasks. An
    inner join can, and can also broadcast a small left side, so the matched rows come
    from one and the unmatched rows of ``left`` are added. Both sides are read twice:
    keep them as stages first.
    """
    other = right.withColumnRenamed(right_key, "__match")
    matched = left.join(other, F.expr(f"{left_key} = __match")).drop("__match")
    alone = unmatched(left, right, left_key, right_key)
    return matched.unionByName(alone, allowMissingColumns=True)


def restrict_to_keys(frame: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among ``keys`` (a one-column frame), none repeated.

    Placed after an aggregate on the column, Catalyst moves it below the aggregate when
    the keys are small enough to broadcast, and keeps it above otherwise.
    """
    return frame.join(keys.toDF("__key"), F.expr(f"{column} = __key"), "left_semi")


def unmatched(frame: DataFrame, other: DataFrame, column: str, other_column: str) -> DataFrame:
    """Rows of ``frame`` with no match in ``other``; a null key has no match."""
    # A repeated key of the right side, however hot, is one row after combining before the shuffle.
    keys = other.selectExpr(f"{other_column} as __key").filter("__key is not null").distinct()
    return frame.join(keys, F.expr(f"{column} = __key"), "left_anti")


def excluded_values(exclusions: DataFrame, report: str, criterion: str) -> DataFrame:
    """The whole numbers a report excludes under one criterion, in a column ``excluded``.

    Deleted entries do not count, and an entry that is not a number excludes nothing.
    """
    mine = (F.col("ReportName") == report) & (F.col("Criteria") == criterion)
    return (
        exclusions.filter(mine).filter("Deleted = 0 and ExclusionID is not null")
        .selectExpr("try_cast(Value as bigint) as excluded").filter("excluded is not null").distinct()
    )


def exclude(
    frame: DataFrame, exclusions: DataFrame, report: str, criteria: Mapping[str, str], counts: RunCounts | None = None
) -> DataFrame:
    """Drop the rows that a data-driven exclusion list names.

    ``criteria`` maps a criterion of the list to the column it is compared with. ``counts`` learns of each criterion how many rows
    there were and how many were kept.
    """
    for criterion, column in criteria.items():
        step = f"exclude {criterion}"
        if counts is not None:
            frame = counts.watch(frame, step, rows=F.count("*"))
        frame = unmatched(frame, excluded_values(exclusions, report, criterion), column, "excluded")
        if counts is not None:
            frame = counts.watch(frame, step, kept=F.count("*"))
    return frame


def count_matches(frame: DataFrame, other: DataFrame, column: str, other_column: str, name: str) -> DataFrame:
    """Add the number of matching rows of ``other``, zero where there is none."""
    counts = other.groupBy(F.col(other_column).alias("__key")).agg(F.expr("count(*) as __n"))
    joined = frame.join(counts, F.expr(f"{column} = __key"), "left")
    return joined.withColumn(name, F.expr("coalesce(__n, 0)")).drop("__key", "__n")
