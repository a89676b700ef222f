"""Row counts taken in the pass that writes a result, without reading anything twice."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_PATIENCE = 10.0


class RunCounts:
    """Counts of a run, each attached to the step whose rows it counts.

    A count is there once an action has run its step; a step that the optimizer left out of the plan (an empty side of a join,
    say) has none. Counting keeps filters from being moved across the step.
    """

    def __init__(self):
        self._observed: list[tuple[str, Observation]] = []

    def watch(self, frame: DataFrame, step: str, **measures: Column) -> DataFrame:
        """``frame``, with aggregates of its rows taken on the way, ``rows`` being their number unless others are given."""
        measures = measures or {"rows": F.count("*")}
        observed = Observation(f"{step}-{uuid.uuid4().hex}")
        self._observed.append((step, observed))
        return frame.observe(observed, *[column.alias(name) for name, column in measures.items()])

    def totals(self, wait: float = _PATIENCE) -> dict[str, int]:
        """``{"step.measure": value}`` of the steps that ran; a step watched in several places is added up."""
        found: dict[str, int] = {}
        until = time.monotonic() + wait
        for step, observed in self._observed:
            # The metrics arrive with the end of the action, shortly after it has returned.
            while not _arrived(observed) and time.monotonic() < until:
                time.sleep(0.02)
            for measure, value in _values(observed).items():
                found[f"{step}.{measure}"] = found.get(f"{step}.{measure}", 0) + int(value or 0)
        return found


def _arrived(observed: Observation) -> bool:
    """``Observation.get`` waits for ever where no action has run the frame; this asks first."""
    return observed._jo is not None and observed._jo.future().isCompleted()


def _values(observed: Observation) -> dict[str, int]:
    if not _arrived(observed):
        return {}
    try:
        return observed.get
    except Py4JJavaError:  # a row without columns: the plan that ran did not hold the step
        return {}
