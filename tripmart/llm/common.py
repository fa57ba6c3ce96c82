"""What several corpus operators share: joins that survive hot keys, and bounded pieces of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in so many rows; so there are fewer hot keys than this, whatever the size.
HOT_SHARE = 1000
#: Bytes of text that a task works on at a time.
PIECE_BYTES = 1 << 20


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Left join of rows with one row per key, where any key may hold a large share of the rows.

    ``groups`` has the number of rows of each key in column ``size``. Keys above 1/1000 of all rows number fewer than
    1000, so they are broadcast and their rows are never shuffled; the others meet in an ordinary join, whose keys are
    all small. ``rows`` and ``groups`` are read more than once: pass tables, not long plans. Keys must not be null.
    """
    total = groups.agg(F.sum(size).alias("n")).first()["n"] or 0
    hot = groups.where(F.col(size) * HOT_SHARE > F.lit(total))
    cold = groups.where(F.col(size) * HOT_SHARE <= F.lit(total))
    near = rows.join(F.broadcast(hot), keys, "inner")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold.hint("merge"), keys, "left")
    return near.unionByName(rest)


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut, without copying, into runs of rows whose values of a string or binary column take about
    ``limit`` bytes; a longer value comes alone."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    """The batch with columns added, or replaced where the name is there already."""
    names = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(new.values()), names + list(new))


def schema_with(df: DataFrame, **new: str) -> str:
    """DDL of the frame's columns followed by new ones; an old column of the same name makes way."""
    old = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in new]
    return ", ".join(old + [f"`{name}` {kind}" for name, kind in new.items()])


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of a string column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
