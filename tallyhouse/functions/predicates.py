"""Reusable filter conditions. Each is pushed to the scan where the source allows it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import moment


def valid_at(now: datetime, invalid: Column, valid_from: Column, valid_thru: Column) -> Column:
    """Not marked invalid and in force at ``now``; an open end is null."""
    at = moment(now)
    return (invalid == 0) & (valid_from <= at) & ((valid_thru >= at) | valid_thru.isNull())


def optional_filter(column: Column, value: object | None) -> Column:
    """``column = value``, or any known ``column`` when no value is given.

    Rows with a null ``column`` are dropped either way.
    """
    return column.isNotNull() if value is None else column == F.lit(value)


def day_window(column: Column, low: datetime, high: datetime) -> Column:
    """Times on or after ``low`` and before ``high``, both at midnight."""
    return (column >= moment(low)) & (column < moment(high))


def like_text(column: Column, pattern: str, case_insensitive: bool = True) -> Column:
    return column.ilike(pattern) if case_insensitive else column.like(pattern)


def like_any(column: Column, patterns: Iterable[str], case_insensitive: bool = True) -> Column:
    """Matches at least one pattern."""
    return reduce(lambda a, b: a | b, (like_text(column, p, case_insensitive) for p in patterns))
