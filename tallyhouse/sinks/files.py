"""Small files and folders on whatever file system a path names, through Hadoop's interface."""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Reads, writes, lists, removes and claims below any root that Spark itself can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, folder: str) -> dict[str, datetime]:
        """What a folder holds and when each was last changed; a missing folder holds nothing."""
        system, place = self._at(folder)
        if not system.exists(place):
            return {}
        return {status.getPath().getName(): datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
                for status in system.listStatus(place)}

    def write(self, path: str, text: str) -> None:
        system, place = self._at(path)
        out = system.create(place, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        """Remove a file, or a folder and all in it."""
        system, place = self._at(path)
        system.delete(place, True)

    def claim(self, source: str, target: str) -> bool:
        """Rename ``source`` to ``target`` unless that exists; one of several claimants succeeds.

        Atomic where renaming is, as on HDFS and local disks.
        """
        system, place = self._at(source)
        _, goal = self._at(target)
        system.mkdirs(goal.getParent())
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        never_over = self._gateway.new_array(rename, 1)
        never_over[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf)
        try:
            context.rename(place, goal, never_over)
        except Py4JJavaError as error:
            if system.exists(goal):
                return False
            raise error
        return True
