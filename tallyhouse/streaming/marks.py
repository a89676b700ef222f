"""Where an incremental extract has got to, kept together with what it extracted.

Each finished window is one generation of a log: its rows and its bounds become visible by the same atomic rename. The mark is
the end of the last one, so it can neither be ahead of the rows nor behind them: a run that dies before the rename has done
nothing, and after it has done everything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sinks.counts import RunCounts
from tallyhouse.sinks.generations import Generation, Generations
from tallyhouse.streaming.highwater import Extract, resolve_window

Source = Callable[[datetime, datetime], Extract]


@dataclass(frozen=True)
class Committed:
    """A window whose rows are committed. ``fresh`` tells that this run did it; a rerun finds it done."""

    low: datetime
    high: datetime
    rows: int
    folder: str
    fresh: bool


class ExtractLog:
    """The windows of one extract below ``root``, each beginning where the one before ended."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._log = spark, Generations(spark, root)

    def windows(self) -> list[Committed]:
        return [_committed(self._log.get(number), False) for number in self._log.numbers()]

    def mark(self) -> datetime | None:
        """The end of the last committed window; None before the first."""
        latest = self._log.latest()
        return datetime.fromisoformat(latest.facts["high"]) if latest else None

    def run(self, source: Source, *, now: datetime, low: datetime | None = None, high: datetime | None = None) -> Committed | None:
        """Extract and commit the next window: from the mark for one day, unless bounds are given. None if it is not over at ``now``.

        Without a mark the window is that of a first run, yesterday. A window already committed is left as it is and returned; one that would
        leave days out or take them twice raises ``ValueError``. If another run commits first, nothing is kept of this
        one and the other's window is returned.
        """
        base, mark = self._log.latest_number(), self.mark()
        if low is not None and mark is not None and low != mark:
            for done in self.windows():
                if (done.low, done.high) == (low, high or done.high):
                    return done
            raise ValueError(f"the window from {low} does not begin at the mark, {mark}")
        low, high = resolve_window(mark if low is None else low, high, now)
        if high <= low:
            raise ValueError(f"the window from {low} to {high} is empty")
        if high > now:
            return None
        folder, counts = self._log.attempt(), RunCounts()
        counts.watch(source(low, high).rows, "extract").write.mode("errorifexists").parquet(folder)
        facts = {"low": low.isoformat(), "high": high.isoformat(), "rows": counts.totals().get("extract.rows", 0)}
        published = self._log.commit(base, folder, facts)
        if published is None:
            self._log.discard(folder)
            return _committed(self._log.get(base + 1), False)
        return _committed(published, True)

    def catch_up(self, source: Source, *, now: datetime) -> list[Committed]:
        """Day after day until the mark has reached the last day that is over."""
        done = []
        while (window := self.run(source, now=now)) is not None:
            done.append(window)
        return done

    def rows(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The rows of all committed windows, with ``window_start``; of those that begin in ``[since, until)`` if given."""
        wanted = [w for w in self.windows() if (since is None or w.low >= since) and (until is None or w.low < until)]
        if not wanted:
            raise ValueError("no window is committed there")
        # One scan of all folders; the folder of a row tells its window.
        starts = F.create_map(*[F.lit(x) for w in wanted for x in (w.folder.rsplit("/", 1)[1], w.low)])
        attempt = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return self._spark.read.parquet(*[w.folder for w in wanted]).withColumn("window_start", starts[attempt].cast("timestamp_ntz"))

    def sweep(self) -> list[str]:
        """Remove what dead runs left behind; every committed window stays."""
        return self._log.sweep(max(1, len(self._log.numbers())))


def _committed(generation: Generation, fresh: bool) -> Committed:
    facts = generation.facts
    return Committed(datetime.fromisoformat(facts["low"]), datetime.fromisoformat(facts["high"]), int(facts["rows"]), generation.folder, fresh)
