"""Incremental runs over half-open day windows, each ending where the next begins.

The windows are batch parameters: the reports have no event-time streaming.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame

_DAY = timedelta(days=1)


def _midnight(value: datetime) -> datetime:
    return datetime.combine(value.date(), time.min)


def _next_midnight(value: datetime) -> datetime:
    """``value`` at midnight, else the midnight after it.

    Comparing whole days with a bound inside a day gives the same rows.
    """
    floor = _midnight(value)
    return floor if floor == value else floor + _DAY


def resolve_window(
    low: datetime | None, high: datetime | None, now: datetime
) -> tuple[datetime, datetime]:
    """Bounds of a run: yesterday by default, one day long unless ``high`` says otherwise.

    The returned bounds are as given, for chaining; use :func:`day_aligned` to filter.
    """
    if low is None:
        low = _midnight(now) - _DAY
    return low, low + _DAY if high is None else high


def day_aligned(low: datetime, high: datetime) -> tuple[datetime, datetime]:
    """The midnights that select the same whole days as the bounds."""
    return _next_midnight(low), _next_midnight(high)


@dataclass(frozen=True)
class Extract:
    """Rows of one run and the mark the next run starts from."""

    rows: DataFrame
    low: datetime
    new_mark: datetime
