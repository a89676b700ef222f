"""Numbered generations of a result, each published by one atomic rename.

Below the root, ``data/<attempt>`` holds the rows of one attempt and ``log/<number>/entry.json`` names the attempt that became
that generation. An attempt is invisible until its entry is renamed into place, and a number can be taken once, so of two writers that
started from the same generation one wins and the other learns that it lost. A run that dies leaves an attempt that nothing
names; :meth:`Generations.sweep` removes it later, with the generations beyond the last few.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sinks.files import Files

ABANDONED_AFTER = timedelta(days=2)


@dataclass(frozen=True)
class Generation:
    """A published generation: its number, the folder of its rows, and what was recorded with it."""

    number: int
    folder: str
    facts: Mapping[str, object] = field(default_factory=dict)


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._files, self.root = spark, Files(spark), root.rstrip("/")

    def _entry(self, number: int) -> str:
        return f"{self.root}/log/{number:010d}"

    def numbers(self) -> list[int]:
        return sorted(int(name) for name in self._files.names(f"{self.root}/log") if name.isdigit())

    def get(self, number: int) -> Generation:
        entry = json.loads(self._files.read(f"{self._entry(number)}/entry.json"))
        return Generation(number, f"{self.root}/data/{entry['attempt']}", entry["facts"])

    def latest(self) -> Generation | None:
        numbers = self.numbers()
        return self.get(numbers[-1]) if numbers else None

    def latest_number(self) -> int:
        """The number of the latest generation, 0 before the first."""
        return max(self.numbers(), default=0)

    def attempt(self) -> str:
        """A folder of its own for the rows of a new attempt."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def commit(self, base: int, folder: str, facts: Mapping[str, object] | None = None) -> Generation | None:
        """Make the attempt the generation after ``base``; None if another writer did so first. The attempt's folder stays then."""
        attempt = folder.rsplit("/", 1)[1]
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        self._files.write(f"{draft}/entry.json", json.dumps({"attempt": attempt, "facts": dict(facts or {})}))
        won = self._files.claim(draft, self._entry(base + 1))
        if not won:
            self._files.remove(draft)
        # Where a rename is a copy, both may have been told that they won: the entry itself says who did.
        found = self.get(base + 1)
        return found if won and found.folder == folder else None

    def read(self, generation: Generation, schema=None) -> DataFrame:
        reader = self._spark.read if schema is None else self._spark.read.schema(schema)
        return reader.parquet(generation.folder)

    def discard(self, folder: str) -> None:
        self._files.remove(folder)

    def sweep(self, keep: int, abandoned_after: timedelta = ABANDONED_AFTER) -> list[str]:
        """Remove all but the last ``keep`` generations, and attempts and drafts that nothing names and nobody has touched lately.

        The entry goes before its rows, so no entry ever names missing rows. Returns what was removed.
        """
        if keep < 1:
            raise ValueError("the latest generation stays")
        numbers = self.numbers()
        named, gone = set(), []
        for number in numbers[-keep:]:
            named.add(self.get(number).folder)
        for number in numbers[:-keep]:
            folder = self.get(number).folder
            self._files.remove(self._entry(number))
            if folder not in named:
                self._files.remove(folder)
                gone.append(folder)
        oldest = datetime.now(timezone.utc) - abandoned_after
        for kind in ("data", "drafts"):
            for name, changed in self._files.names(f"{self.root}/{kind}").items():
                folder = f"{self.root}/{kind}/{name}"
                if folder not in named and changed <= oldest:
                    self._files.remove(folder)
                    gone.append(folder)
        return gone
