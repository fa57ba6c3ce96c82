"""Row numbers and ranks of a whole table in a total order, without a task that holds it all.

Rows are dealt over ranges of the order, sorted within, and written with their range and place. How many rows a range has, and with
which sort key it begins and ends, is one row per range; from these the driver, which knows the ranges as tasks anyway, adds up where
each range starts, and carries the start of a key that goes on from range to range. A number is then a start plus a place: one
shuffle in all, and no window over the whole table.

Rows that are equal in the order are told apart by a hash of the whole row, so a key that holds a large share of all rows is spread
over ranges like any other. Equal rows get neighbouring numbers, in any way, which makes no difference to the result: numbers do
not depend on how the input is partitioned, nor on the number of ranges. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.workspace import materialise

_PLACES = (1 << 33) - 1


def _hashes(columns: list[Column]) -> tuple[Column, Column]:
    """Two hashes that tell values apart, nulls included."""
    flagged = [x for c in columns for x in (c.isNull(), c)]
    return F.xxhash64(*flagged), F.xxhash64(F.lit(1), *flagged)


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    return _hashes([F.col(f"`{c}`") for c in df.columns])


def _ranges(df: DataFrame, ranges: int | None) -> int:
    return ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(df: DataFrame, order: list[Column], ranges: int | None, **more: Column) -> DataFrame:
    """The rows as a struct, in ranges of the order and sorted within them."""
    tie_a, tie_b = _row_hashes(df)
    keys = [f"o{i}" for i in range(len(order))]
    plain = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        *[column.alias(name) for name, (column, _) in zip(keys, order, strict=True)],
        tie_a.alias("tie_a"),
        tie_b.alias("tie_b"),
        *[column.alias(name) for name, column in more.items()],
    )
    by = [sort(name) for name, (_, sort) in zip(keys, order, strict=True)] + [F.asc("tie_a"), F.asc("tie_b")]
    return plain.repartitionByRange(_ranges(df, ranges), *by).sortWithinPartitions(*by)


def ascending(column: str) -> tuple[Column, object]:
    """A sort key, nulls first."""
    return F.col(column), F.asc_nulls_first


def descending(column: str) -> tuple[Column, object]:
    """A sort key, nulls last."""
    return F.col(column), F.desc_nulls_last


def _starts(spark, sums: list[tuple], ddl: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(sums, ddl))  # a row per range, that is per task


def numbered(df: DataFrame, order: list[tuple], name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """The table with consecutive numbers from 1 in the order; a total order of the columns makes them stable ids."""
    dealt = _dealt(df, order, ranges).select(
        F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)).alias("place"),
        "row",
    )
    written = materialise(dealt, "numbered")
    start, starts = 0, []
    for row in sorted(written.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((row.range, start))
        start += row.n
    placed = written.join(_starts(df.sparkSession, starts, "range int, start bigint"), "range")
    return placed.select((F.col("start") + F.col("place") + 1).alias(name), "row.*")


def ranked(df: DataFrame, order: list[tuple], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """The table with the rank of each row in the order: 1 and the number of rows before it, ties alike."""
    key_a, key_b = _hashes([column for column, _ in order])
    dealt = _dealt(df, order, ranges, key_a=key_a, key_b=key_b).select("key_a", "key_b", "row")

    def run(batches):
        """Adds to each row its place in the range, and that of the first row with its key."""
        place, last, first = 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("key_a").to_numpy(), batch.column("key_b").to_numpy()
            places = np.arange(place, place + len(a))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            new[0] = last != (a[0], b[0])
            firsts = np.maximum.accumulate(np.where(new, places, first))
            place, last, first = place + len(a), (a[-1], b[-1]), int(firsts[-1])
            part = pa.array(np.full(len(a), TaskContext.get().partitionId(), np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, part, pa.array(places), pa.array(firsts)], [*batch.schema.names, "range", "place", "first"]
            )

    kind = dealt.schema["row"].dataType.simpleString()
    written = materialise(
        dealt.mapInArrow(run, f"key_a bigint, key_b bigint, row {kind}, range int, place bigint, first bigint"), "ranked"
    )
    key = F.struct("key_a", "key_b")
    summary = written.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(key, "place").alias("begins"),
        F.max_by(key, "place").alias("ends"),
        F.max("first").alias("last_first"),
    )
    start, starts, carried = 0, [], (None, 0)
    for row in sorted(summary.collect()):
        begin = carried[1] if carried[0] == row.begins else start
        starts.append((row.range, start, begin))
        carried = (row.ends, start + row.last_first if row.last_first else begin)
        start += row.n
    placed = written.join(_starts(df.sparkSession, starts, "range int, start bigint, begin bigint"), "range")
    rank = F.when(F.col("first") == 0, F.col("begin")).otherwise(F.col("start") + F.col("first")) + 1
    return placed.select(rank.alias(name), "row.*")
