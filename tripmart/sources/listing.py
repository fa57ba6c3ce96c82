"""Files listed and read by tasks.

Spark's own file sources list on the driver, hold every name there, leave out files of zero bytes, and hand a file over as one value
of at most 2 GB. Here a folder tree is a table that grows level by level: each step lists the folders that the step before
found, in tasks, and writes what it saw. The driver knows the root, the number of folders of a level and the number of levels, but no
name. Bytes are read in ranges (``read_ranges``), so one large file is shared out over many tasks, or streamed in steps.

Tasks open paths by pyarrow: local ones, and those of the stores it has clients for. Names that begin with a dot, or with an
underscore and have no ``=``, are hidden, as in any scan by Spark. What disappears while it is listed is left out; a folder that
cannot be read is an error. A single folder is listed by one task, entry by entry.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.workspace import materialise

#: Folders that a task lists, files that a task opens, bytes that a task reads: about.
FOLDERS_PER_TASK, FILES_PER_TASK, BYTES_PER_TASK = 512, 1024, 64 << 20
#: Ranges of a file that one task reads one after the other, opening it once: so many, and so many bytes, at most about.
RANGES_TOGETHER, BYTES_TOGETHER = 1024, 16 << 20
#: Bytes read at a time.
STEP = 1 << 20
_ENTRY = "path string, is_folder boolean, length bigint, modified_at timestamp"
_ARROW = pa.schema(
    [("path", pa.string()), ("is_folder", pa.bool_()), ("length", pa.int64()), ("modified_at", pa.timestamp("us", tz="UTC"))]
)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the session's file systems understand it, with its scheme. A path that is not there is an error."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(there):
        raise FileNotFoundError(path)
    return re.sub("^file:/+", "file:///", files.makeQualified(there).toString())


def opener(uri: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs

    if uri.startswith("file://"):
        return fs.LocalFileSystem(), uri.removeprefix("file://")
    return fs.FileSystem.from_uri(uri)


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _entries(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(path, is it a folder, length, microseconds) of everything in a folder; of a file itself."""
    from pyarrow import fs

    files, inner = opener(folder)
    if not isinstance(files, fs.LocalFileSystem):
        root = files.get_file_info(inner)
        prefix = folder[: len(folder) - len(inner.lstrip("/"))]
        found = [root] if root.type == fs.FileType.File else files.get_file_info(fs.FileSelector(inner))
        for x in found:
            is_folder = x.type == fs.FileType.Directory
            yield prefix + x.path.lstrip("/"), is_folder, None if is_folder else x.size, (x.mtime_ns or 0) // 1000
        return
    if os.path.isfile(inner):
        yield folder, False, os.path.getsize(inner), os.stat(inner).st_mtime_ns // 1000
        return
    with os.scandir(inner) as found:
        for entry in found:
            try:
                stat, is_folder = entry.stat(), entry.is_dir()
            except FileNotFoundError:
                continue
            yield f"file://{entry.path}", is_folder, None if is_folder else stat.st_size, stat.st_mtime_ns // 1000


def _listed(batches):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    held = []
    for folders in batches:
        for folder in folders.column("path").to_pylist():
            for entry in _entries(folder):
                if not _hidden(entry[0].rsplit("/", 1)[-1]):
                    held.append(entry)
                if len(held) == 10_000:
                    yield batch(held)
                    held = []
    if held:
        yield batch(held)


def walk(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified_at`` of every file below a path, empty ones included."""
    folders, n, levels = spark.createDataFrame([(qualified(spark, path),)], "path string"), 1, []
    while n:
        # what a few folders hold is not known: they go to as many tasks as run at once
        tasks = max(-(-n // FOLDERS_PER_TASK), min(n, spark.sparkContext.defaultParallelism))
        shared = folders.repartition(tasks, "path")
        level = materialise(shared.mapInArrow(_listed, _ENTRY), "entries")
        levels.append(level.where("NOT is_folder").drop("is_folder"))
        folders = level.where("is_folder").select("path")
        n = folders.count()
    return reduce(DataFrame.unionAll, levels)


def matches(path: Column, pattern: str) -> Column:
    """Does the last part of a path fit a shell pattern (``* ? [a-z] [!a] {a,b}``)?"""
    out, depth, at = "", 0, 0
    while at < len(pattern):
        c, end = pattern[at], pattern.find("]", at + 2)
        if c == "[" and end > 0:
            out += "[" + re.sub(r"^!", "^", pattern[at + 1 : end]).replace("\\", "\\\\") + "]"
            at = end
        elif c in "{}":
            out, depth = out + ("(?:" if c == "{" else ")"), depth + (1 if c == "{" else -1)
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": ".*", "?": "."}.get(c) or re.escape(c)
        at += 1
    return F.substring_index(path, "/", -1).rlike(f"^(?:{out})$")


def spread(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of files or of their ranges dealt over tasks by the bytes and the number of the files. Neighbouring ranges of a file stay
    together, up to a bound, in their order."""
    size = files.agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(1, -(-(size.bytes or 0) // BYTES_PER_TASK), -(-size.n // FILES_PER_TASK))
    if "number" not in rows.columns:
        return rows.repartition(tasks, "path")
    by_bytes = F.floor(F.col("number") * F.col("length") / F.col("ranges") / BYTES_TOGETHER)
    together = F.greatest(by_bytes, F.floor(F.col("number") / RANGES_TOGETHER))
    return rows.repartition(tasks, "path", together).sortWithinPartitions("path", "number")


def ranges(files: DataFrame, size: int | Column) -> DataFrame:
    """``path, length, number, ranges``: a row per range of ``size`` bytes; an empty file has one, of no bytes."""
    count = F.greatest(F.ceil(F.col("length") / F.lit(size)), F.lit(1)).cast("bigint").alias("ranges")
    return files.select("path", "length", count).withColumn("number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ranges") - 1)))


def pieces_of(file, start: int, end: int, step: int = STEP) -> Iterator[bytes]:
    """The bytes from start to end of an open file, some at a time."""
    file.seek(start)
    while start < end:
        piece = file.read(min(step, end - start))
        if not piece:
            return
        start += len(piece)
        yield piece


def read_ranges(rows: DataFrame, work: Callable, result: str, schema: str) -> DataFrame:
    """For every row (with a path) the value that ``work(open file, row)`` makes of it, as a column; the others stay. Rows of one path
    that follow each other share an open file."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(StructType.fromDDL(f"x {schema}")["x"].dataType)

    def run(batches):
        with ExitStack() as held:
            opened, file = None, None
            for batch in batches:
                values = []
                for row in batch.to_pylist():
                    if row["path"] != opened:
                        held.close()
                        files, path = opener(row["path"])
                        opened, file = row["path"], held.enter_context(files.open_input_file(path))
                    values.append(work(file, row))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)], [*batch.schema.names, result])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{names}, {result} {schema}")
