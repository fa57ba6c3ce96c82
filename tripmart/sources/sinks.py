"""Writers. Row counts come from an observation on the write itself, not from a second job."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.sources.listing import opener, qualified

#: Files that a task of ``write_files`` writes: about.
FILES_PER_TASK = 1024


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    rebalance: bool = False,
    last_step: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Overwrite a Parquet table (snappy) and return the number of rows written.

    ``rebalance`` shuffles by the partition columns with adaptive sizing: a value holding a large share of the rows is
    split over many tasks, small ones are packed together, so neither one task nor thousands of tiny files per
    partition result. Leave it off when the input files already follow the partition columns.
    ``last_step`` and the row count sit after that shuffle, in the writing stage: a task that runs again replaces both.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if last_step is not None:
        df = last_step(df)
    written = Observation()
    writer = (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return written.get["rows"]


def write_csv(df: DataFrame, path: str) -> int:
    """Overwrite a CSV folder; every part file starts with the header line."""
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return written.get["rows"]


def write_files(lines: DataFrame, base: str) -> int:
    """One file per ``path`` (below the base) that holds its ``line`` values, bytes, each ended by a line break (a null one adds nothing);
    returns the number of files. Tasks write them: a file appears under its name when it is complete, so a task that runs again replaces its own, and
    the driver has no work per file, as it has when a partitioned write is committed. Lines of a file are in order of their bytes."""
    spark = lines.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    root = qualified(spark, base)
    tasks = max(1, -(-lines.count() // FILES_PER_TASK))

    def run(batches):
        files, inner = opener(root)
        made, open_path, stream, n = set(), None, None, 0

        def finish() -> None:
            stream.close()
            files.move(draft, f"{inner}/{open_path}")

        for batch in batches:
            for path, line in zip(batch.column("path").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if path != open_path:
                    if stream is not None:
                        finish()
                    parent, _, name = f"{inner}/{path}".rpartition("/")
                    if parent not in made:
                        files.create_dir(parent)
                        made = {parent}
                    open_path, draft, n = path, f"{parent}/.{name}-{uuid.uuid4().hex}", n + 1
                    stream = files.open_output_stream(draft)
                if line is not None:
                    stream.write(line + b"\n")
        if stream is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    dealt = lines.select("path", "line").repartition(tasks, "path").sortWithinPartitions("path", "line")
    return dealt.mapInArrow(run, "files bigint").agg(F.sum("files")).first()[0] or 0


def land_batch(df: DataFrame, path: str, year: int, month: int) -> int:
    """Write a batch below ``year=/month=`` of its load date, replacing an earlier load of that month only. The month's
    own folder is overwritten, so an empty batch replaces too (it leaves a file without rows)."""
    landed = Observation()
    (
        df.observe(landed, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(f"{path}/year={year}/month={month}")
    )
    return landed.get["rows"]


#: Bits of each coordinate that take part in a curve.
_CURVE_BITS = 16


def curve(*coordinates: Column) -> Column:
    """The place of a row on a space-filling curve (Morton order): the bits of whole, non-negative coordinates, interleaved. Rows
    close in all coordinates are close on it. Null and negative coordinates count as 0, large ones by their low bits."""
    parts = []
    for k, coordinate in enumerate(coordinates):
        value = F.greatest(F.coalesce(coordinate.cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
        parts += [F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1)).cast("bigint"), i * len(coordinates) + k) for i in range(_CURVE_BITS)]
    return reduce(Column.bitwiseOR, parts)


def write_clustered(df: DataFrame, path: str, partition_by: str, along: Column, files: int, group_bytes: int = 8 << 20) -> int:
    """Overwrite a Parquet table whose files and row groups are small stretches of a curve within each partition, so that a filter
    on any of the curve's coordinates skips most of them by their statistics. One shuffle, by ranges of partition and curve: a
    partition holding a large share of the rows is cut into many. Returns the number of rows."""
    written = Observation()
    ordered = df.withColumn("curve key", along).repartitionByRange(files, partition_by, "curve key")
    (
        ordered.sortWithinPartitions(partition_by, "curve key")
        .drop("curve key")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.block.size", group_bytes)
        .partitionBy(partition_by)
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )
    return written.get["rows"]
