"""Scalar expressions with the null and type rules the reports depend on."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def moment(value: datetime | date) -> Column:
    """A point in time as a zone-less literal, independent of the session time zone."""
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def iif(condition: Column, then: Column | object, otherwise: Column | object) -> Column:
    """Two-way choice; an unknown condition takes the second branch."""
    return F.when(condition, then).otherwise(otherwise)


def first_known(column: Column, default: Column | object, dtype: DataType | str) -> Column:
    """``column``, or ``default`` where it is null, in the type of ``column``."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(column.cast(dtype), fallback.cast(dtype))


def decode(column: Column, names: Mapping[object, str], other: str) -> Column:
    """Name of a code; nulls and codes without a name give ``other``."""
    choice = None
    for code, name in names.items():
        choice = (F if choice is None else choice).when(column == F.lit(code), F.lit(name))
    return choice.otherwise(F.lit(other))


def strip_breaks(column: Column) -> Column:
    """Text without line feeds, carriage returns and tabs."""
    return F.translate(column, "\n\r\t", "")


def as_text(column: Column) -> Column:
    return column.cast("string")


def as_number(column: Column) -> Column:
    """Text as a whole number; null where it is not one."""
    return column.try_cast("bigint")


def day(column: Column) -> Column:
    """Calendar day of a time."""
    return column.cast("date")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(day(end), day(start))
