"""Intermediate results written once and read several times."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sinks.files import Files

CHECKPOINT_DIR = "spark.checkpoint.dir"
LIFETIME = timedelta(days=2)
OWNER = "_owner.json"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Files that are read a few times and then removed take a third less room than with Spark's default.
CODEC = "zstd"


@contextmanager
def tidy_writes(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go as each write ends, and not when the driver happens to collect garbage.

    A write has a plan of its own, so nothing else can want its shuffle files again.
    """
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the checkpoint folder set on the context."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return folder.rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder and all in it, on whatever file system it is."""
    Files(spark).remove(folder)


def own_folder(spark: SparkSession, folder: str, lifetime: timedelta = LIFETIME) -> str:
    """Mark a folder as this application's until it expires; marking it again puts that off."""
    expires = datetime.now(timezone.utc) + lifetime
    Files(spark).write(f"{folder}/{OWNER}", json.dumps({"owner": spark.sparkContext.applicationId, "expires": expires.isoformat()}))
    return folder


def owned_folder(spark: SparkSession, kind: str, root: str | None = None, lifetime: timedelta = LIFETIME) -> str:
    """A new folder of this application below the shared one, to be removed by :func:`sweep`."""
    return own_folder(spark, f"{root or shared_folder(spark)}/{kind}-{uuid.uuid4().hex}", lifetime)


def sweep(spark: SparkSession, root: str | None = None, *, mine: bool = False, now: datetime | None = None) -> list[str]:
    """Remove the marked folders that have expired, and with ``mine`` all of this application; returns their names.

    Nothing without a mark is touched. ``mine`` is for the end of an application, when all that was made from its
    stages has been written.
    """
    files, root = Files(spark), root or shared_folder(spark)
    now, gone = now or datetime.now(timezone.utc), []
    for name in files.names(root):
        try:
            mark = json.loads(files.read(f"{root}/{name}/{OWNER}"))
        except Py4JJavaError:  # no mark, or another run is removing it just now
            continue
        if datetime.fromisoformat(mark["expires"]) <= now or (mine and mark["owner"] == spark.sparkContext.applicationId):
            files.remove(f"{root}/{name}")
            gone.append(name)
    return gone


_SWEPT: set[tuple[str, str]] = set()


class StageArea:
    """Writes a stage as Parquet in the shared folder and hands back a scan of it.

    A stage survives the loss of executors, cuts the plan's lineage, and has a known
    size, so that later joins broadcast it only when it really is small.
    Each area has its own folder; nothing is ever overwritten. ``close`` removes it, once
    what was made from the stages is written::

        with StageArea(spark) as stages:
            ar_aging(tables, now=now, stages=stages).write.parquet(...)

    ``drop`` removes single stages before that, once all that reads them is a stage itself.
    The folder carries its owner and when it expires, which each stage puts off. An application's first stage sweeps
    away what earlier ones left past that time; ``sweep(spark, mine=True)`` ends its own.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, lifetime: timedelta = LIFETIME):
        self._spark = spark
        self._root = root
        self._run = uuid.uuid4().hex
        self._lifetime = lifetime

    @property
    def folder(self) -> str:
        if self._root is None:
            self._root = shared_folder(self._spark)
        return f"{self._root}/stages-{self._run}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        here = (self._spark.sparkContext.applicationId, self._root)
        if here not in _SWEPT:
            _SWEPT.add(here)
            sweep(self._spark, self._root)
        own_folder(self._spark, self.folder, self._lifetime)
        with tidy_writes(self._spark):
            frame.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        return self._spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self._spark, f"{self.folder}/{name}")

    def close(self) -> None:
        remove_folder(self._spark, self.folder)

    def __enter__(self) -> StageArea:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


class NoStages:
    """Keeps nothing: every stage stays part of one lazy plan."""

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        return frame

    def drop(self, *names: str) -> None:
        pass
