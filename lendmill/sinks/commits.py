"""Which batch of which writer has begun to fill a table, and which has filled it.

A batch load, a stream and a replay share a table by one rule: a batch is named by its writer
and its number, ``begin`` before it appends and ``finish`` after. What ``begin`` answers tells
what has to be compared:

* ``NEW``: nothing of this batch is in the table;
* ``RETRY``: an attempt ended somewhere in between, so the table may hold a part of it;
* ``DONE``: all of it is there, and nothing is left to do.

The state of a batch is one empty file, renamed when it is done, so a crash leaves either.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import SparkSession

NEW, RETRY, DONE = "new", "retry", "done"


class Folder:
    """A few operations on paths of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.root = self._path(path)
        self.files = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(self.root, name)

    def exists(self, name: str) -> bool:
        return self.files.exists(self.at(name))

    def create(self, name: str) -> None:
        self.files.create(self.at(name), True).close()

    def rename(self, old: str, new: str) -> None:
        self.files.rename(self.at(old), self.at(new))

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)

    def names(self, name: str = "") -> list[str]:
        """Names of what a folder holds, hidden files left out."""
        place = self.at(name) if name else self.root
        if not self.files.exists(place):
            return []
        found = [s.getPath().getName() for s in self.files.listStatus(place)]
        return sorted(n for n in found if n[0] not in "._")


class Commits:
    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    @staticmethod
    def _name(writer: str, batch: object) -> str:
        return f"{quote(writer, safe='')}/{quote(str(batch), safe='')}"

    def begin(self, writer: str, batch: object) -> str:
        name = self._name(writer, batch)
        if self.folder.exists(f"{name}.done"):
            return DONE
        if self.folder.exists(f"{name}.begun"):
            return RETRY
        self.folder.create(f"{name}.begun")
        return NEW

    def finish(self, writer: str, batch: object, numbered: bool = False) -> None:
        """``numbered``: batches of this writer are numbered without gaps and only the newest
        can come again, so what lies before the one before it is forgotten."""
        name = self._name(writer, batch)
        self.folder.rename(f"{name}.begun", f"{name}.done")
        if numbered and int(str(batch)) >= 2:
            self.folder.delete(f"{self._name(writer, int(str(batch)) - 2)}.done")
