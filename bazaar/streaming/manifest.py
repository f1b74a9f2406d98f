"""Immutable versions of a table or model, published by one atomic create.

A version's data is written to a folder of its own and never changed.  It is
published by creating ``_published/<number>``, whose text names the folder; the
create fails if the number is there already, so a replayed batch can't replace
what readers use.  Retention keeps the newest versions and those with a lease.
All paths go through Hadoop's file system interface.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOG, _LEASES, _DATA = "_published", "_leases", "data"


class Files:
    """The few file operations that the DataFrame API has no word for."""

    def __init__(self, spark: SparkSession, base: str):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(conf)
        self._io = jvm.org.apache.commons.io.IOUtils
        self._util, self._conf = jvm.org.apache.hadoop.fs.FileUtil, conf

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def create(self, path: str, text: str) -> bool:
        """Create a file that must not exist; False if it does."""
        p = self._path(path)
        if self._fs.exists(p):
            return False
        try:
            out = self._fs.create(p, False)
        except Exception as e:  # another writer was first
            if "FileAlreadyExists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def copy(self, path: str, to: str) -> None:
        self._util.copy(self._fs, self._path(path), self._fs, self._path(to), False, self._conf)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Versions:
    """Published versions under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.files = Files(spark, self.base)

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.files.names(f"{self.base}/{_LOG}") if n.isdigit())

    def folder(self, number: int) -> str:
        return f"{self.base}/{_DATA}/{self.files.text(f'{self.base}/{_LOG}/{number}')}"

    def latest(self) -> int | None:
        numbers = self.numbers()
        return numbers[-1] if numbers else None

    def publish(self, number: int, write) -> bool:
        """``write(folder)`` a new version; False if the number is published already."""
        if number in self.numbers():
            return False
        name = f"{number}-{uuid.uuid4().hex[:12]}"
        write(f"{self.base}/{_DATA}/{name}")
        return self.files.create(f"{self.base}/{_LOG}/{number}", name)

    @contextmanager
    def lease(self, number: int | None = None):
        """Folder of a version that retention spares while the block runs."""
        number = self.latest() if number is None else number
        mark = f"{self.base}/{_LEASES}/{number}-{uuid.uuid4().hex[:12]}"
        self.files.create(mark, "")
        try:
            yield self.folder(number)
        finally:
            self.files.remove(mark)

    def retain(self, keep: int) -> None:
        """Remove all but the newest ``keep`` versions and those with a lease."""
        held = {int(n.split("-")[0]) for n in self.files.names(f"{self.base}/{_LEASES}")}
        numbers = self.numbers()
        for n in numbers[:max(0, len(numbers) - keep)]:
            if n not in held:
                folder = self.folder(n)
                self.files.remove(f"{self.base}/{_LOG}/{n}")  # no reader finds it from here on
                self.files.remove(folder)
