"""Tables that are replaced as a whole: versions, a manifest for each, and the live one.

Below the table's folder lie ``data/<version>-<writer>`` and ``manifest/<version>``, a file that names
the data folder. A version counts from the moment its manifest is there; the manifest is written
aside and renamed, which fails if another writer took the number. So a reader sees a whole version
or the one before, and of two writers that started from the same version one fails. Paths go
through the file system that Spark uses; the rename must not replace files there (HDFS, local).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

DIGITS = 12


class VersionConflict(RuntimeError):
    """Another writer has put a newer version in place."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str | None  # of its data; None before the first version


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.base = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._fs.Path(f"{self.base}/{name}" if name else self.base)

    def live(self) -> Version:
        """The newest version that has a manifest."""
        folder = self._path("manifest")
        if not self._files.exists(folder):
            return Version(0, None)
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        numbers = [n for n in names if n.isdigit()]
        if not numbers:
            return Version(0, None)
        newest = max(numbers)
        stream = self._files.open(self._path(f"manifest/{newest}"))
        try:
            named = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Version(int(newest), f"{self.base}/data/{named}")

    def read(self, load: Callable[[str], DataFrame]) -> DataFrame:
        """The live data by ``load(path)``."""
        at = self.live()
        if at.path is None:
            raise FileNotFoundError(f"{self.base} has no version yet")
        return load(at.path)

    def replace(self, write: Callable[[str], None], since: int | None = None) -> Version:
        """Write a new version by ``write(path)`` and make it the live one. ``since`` is the version that
        it was made from (by default the one live now); :class:`VersionConflict` if that is not
        the live one any more, and then nothing changes."""
        number = (self.live().number if since is None else since) + 1
        name = f"{number:0{DIGITS}d}-{uuid.uuid4().hex}"
        write(f"{self.base}/data/{name}")
        self._commit(number, name)
        return Version(number, f"{self.base}/data/{name}")

    def _commit(self, number: int, name: str) -> None:
        aside, final = self._path(f"manifest/.{name}"), self._path(f"manifest/{number:0{DIGITS}d}")
        out = self._files.create(aside, False)
        out.write(bytearray(name.encode()))
        out.close()
        context = self._fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark._jvm.java.lang.reflect.Array.newInstance(self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            if self.live().number >= number:
                raise VersionConflict(f"version {number} of {self.base} is taken")
            context.rename(aside, final, plain)
        except Py4JJavaError as problem:
            if "FileAlreadyExists" not in str(problem.java_exception.getClass().getName()):
                raise
            raise VersionConflict(f"version {number} of {self.base} is taken") from None
        finally:
            self._files.delete(aside, False)
            if self.live().path != f"{self.base}/data/{name}":
                self._files.delete(self._path(f"data/{name}"), True)
