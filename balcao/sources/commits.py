"""A log of commits beside a table: who may add the next version, and which one counts.

Version ``n`` is one small file, ``_commits/<n>.json``, that appears whole or not at all and is
never replaced. Writers prepare their data first, then claim the version after the one they
started from. Of several writers with the same base one claim succeeds; the others find the
file taken, which is their lost race. Readers look at claimed versions only, so unfinished data
is never seen. Everything here is metadata on the driver; its size is the number of versions
kept, which a retention rule bounds.

Exclusive creation is a hard link on local and mounted file systems, and a rename that does not
replace elsewhere; the store must have one of the two.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_COMMITS = "_commits"
_DIGITS = 12


class LostRace(RuntimeError):
    """Raised where another writer has committed on the same base."""


@dataclass(frozen=True)
class Commit:
    number: int
    name: str
    rows: int
    written: int  # milliseconds since 1970
    data: str  # folder beside the log


def _is(error: Py4JJavaError, kind: str) -> bool:
    return error.java_exception.getClass().getName().endswith(kind)


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        context = spark.sparkContext
        self._jvm, self._gateway = context._jvm, context._gateway
        self._configuration = context._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self._path().getFileSystem(self._configuration)

    @staticmethod
    def now() -> int:
        return int(time.time() * 1000)

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _listed(self, *parts: str) -> list:
        try:
            return list(self._fs.listStatus(self._path(*parts)))
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return []
            raise

    def folders(self) -> dict[str, int]:
        """Names of the folders beside the log, and when they were changed last."""
        return {s.getPath().getName(): s.getModificationTime() for s in self._listed() if s.isDirectory()}

    def numbers(self) -> list[int]:
        """Claimed versions, newest first."""
        names = [s.getPath().getName() for s in self._listed(_COMMITS)]
        return sorted((int(n[:_DIGITS]) for n in names if n.endswith(".json") and n[0] != "."), reverse=True)

    def newest(self) -> int:
        """The version a writer starts from; 0 before the first."""
        return next(iter(self.numbers()), 0)

    def read(self, number: int) -> Commit:
        stream = self._fs.open(self._path(_COMMITS, self._name(number)))
        try:
            return Commit(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:0{_DIGITS}d}.json"

    def claim(self, commit: Commit) -> None:
        """Make ``commit`` visible, or fail if its number is taken."""
        final = self._path(_COMMITS, self._name(commit.number))
        prepared = self._path(_COMMITS, f".{uuid.uuid4().hex}")
        stream = self._fs.create(prepared, True)
        stream.write(bytearray(json.dumps(asdict(commit)).encode()))
        stream.close()
        try:
            self._publish(prepared, final)
        except Py4JJavaError as error:
            if _is(error, "FileAlreadyExistsException"):
                raise LostRace(f"version {commit.number} of {self.folder} was committed by another writer") from error
            raise
        finally:
            self._fs.delete(prepared, False)

    def _publish(self, prepared, final) -> None:
        if self._fs.getScheme() == "file":
            local = [self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, prepared)]
            self._jvm.java.nio.file.Files.createLink(*local)
            return
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        uri = self._fs.makeQualified(final).toUri()
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self._configuration).rename(
            prepared, final, options
        )

    def forget(self, number: int) -> None:
        self._fs.delete(self._path(_COMMITS, self._name(number)), False)

    def delete_data(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
