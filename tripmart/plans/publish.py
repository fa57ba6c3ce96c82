"""Tables published together, as a whole or not at all.

A published folder holds versions and manifests::

    versions/<id>/<table>      the files of a table, written once and never changed
    manifests/<number>.json    which path each table has in a version, and its rows

Writers fill a new folder below ``versions`` first, for as long as they like. The version begins to exist with its manifest, which
appears by one rename. Readers take the manifest with the greatest number, so they see the version before or the one after; a job
that dies in between leaves a folder that nobody reads. Tables that a version does not write are carried over from the one before by
their path. Who publishes says which version they started from: if another one came in between, the rename finds its number taken,
and nothing is changed (``Conflict``). A manifest has a line per table: it is all that the driver reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tripmart.workspace import write_bytes


class Conflict(RuntimeError):
    """Another version was published since this one was begun."""


@dataclass(frozen=True)
class Version:
    number: int
    paths: dict[str, str]
    rows: dict[str, int]


NOTHING = Version(0, {}, {})


class Published:
    """A folder of published tables."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self, number: int) -> str:
        return f"{self.base}/manifests/{number:012}.json"

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.base}/manifests")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """A version, the last one unless told otherwise; version 0 has no tables."""
        if number is None:
            number = max(self._numbers(), default=0)
        if not number:
            return NOTHING
        stream = self._files.open(self._path(self._manifest(number)))
        try:
            content = bytes(stream.readAllBytes())
        finally:
            stream.close()
        told = json.loads(content)
        return Version(number, told["paths"], told["rows"])

    def path(self, table: str, number: int | None = None) -> str:
        return f"{self.base}/{self.version(number).paths[table]}"

    def read(self, table: str, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(table, number))

    def begin(self) -> str:
        """A new folder that a version's tables may be written to."""
        return f"{self.base}/versions/{uuid.uuid4().hex}"

    def publish(self, folder: str, rows: dict[str, int], after: int, without: tuple[str, ...] = ()) -> Version:
        """Make the tables of a folder (name to rows), written completely, the version after number ``after``; those of that version
        which are not among them stay, ``without`` some."""
        before = self.version(after)
        inside = folder.removeprefix(f"{self.base}/")
        paths = {**before.paths, **{name: f"{inside}/{name}" for name in rows}}
        counts = {**before.rows, **rows}
        kept = sorted(set(paths) - set(without))
        new = Version(after + 1, {name: paths[name] for name in kept}, {name: counts[name] for name in kept})
        draft = f"{self.base}/manifests/_{uuid.uuid4().hex}"
        write_bytes(self.spark, draft, json.dumps({"paths": new.paths, "rows": new.rows}, indent=1).encode())
        if max(self._numbers(), default=0) > after or not self._renamed(draft, self._manifest(new.number)):
            self._files.delete(self._path(draft), False)
            raise Conflict(f"version {new.number} is there already")
        return new

    def _renamed(self, draft: str, target: str) -> bool:
        """Give the draft its name unless the name is taken."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._path(target).toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
        never[0] = hadoop.Options.Rename.NONE
        try:
            context.rename(self._path(draft), self._path(target), never)
        except Py4JJavaError as problem:
            if "AlreadyExists" in problem.java_exception.getClass().getName():
                return False
            raise
        return True

    def update(self, write: Callable[[str], dict[str, int]], without: tuple[str, ...] = ()) -> Version:
        """Write tables by ``write(folder)``, which returns their rows, and publish them after the version that was the last one when
        it began."""
        after, folder = self.version().number, self.begin()
        return self.publish(folder, write(folder), after, without)

    def clean(self, keep: int = 2) -> int:
        """Forget all but the last versions, and remove folders that none of those left uses. Returns how many folders went. Not for
        times when somebody writes or reads an old version."""
        numbers = self._numbers()
        for number in numbers[:-keep]:
            self._files.delete(self._path(self._manifest(number)), False)
        used = {path.split("/")[1] for number in numbers[-keep:] for path in self.version(number).paths.values()}
        folder, gone = self._path(f"{self.base}/versions"), 0
        if self._files.exists(folder):
            for status in self._files.listStatus(folder):
                if status.getPath().getName() not in used:
                    self._files.delete(status.getPath(), True)
                    gone += 1
        return gone
