"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest, one row per distinct text. A batch is reduced to one row
per digest, anti-joined with the index (a sort-merge join that reads the index as it lies, without a shuffle), and what
is new is appended bucket by bucket. Only digests, ids and lengths are shuffled, never texts.

The caller numbers the batches. A batch that was appended, in whole or in part, before its job died may be appended again
under its number: texts that it brought count as its own, so the second time decides as the first would have. The same number
for another batch is the caller's mistake, and gives up none of the texts that the index holds.

Every append adds a file to each bucket. ``compact`` writes the index anew beside the old one, one sorted file to a bucket, which
later merges read without sorting; a version counts once Spark marked it as whole, so a job that dies leaves the old one.
One job at a time may write to an index.

Two texts are equal if their SHA-256 after deleting every character of ``[\\x20\\x09-\\x0D]`` is equal. Null counts as
empty, and all empty texts are equal. Within a batch the row with the most code points in the original text stays, then
the smallest id (a null id comes last). Rows repeated with the same id and length are one another's copies: each points
to that id, and ``kept`` marks all of them only if the caller's ids are not unique. Columns other than id and text are
ignored, so clashing names cannot occur. An empty batch adds nothing and gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import join_groups
from tripmart.workspace import materialise

#: Buckets of a small index, distinct texts that a bucket should hold at most, and buckets that Spark allows.
BUCKETS, BUCKET_ROWS, MOST_BUCKETS = 256, 4_000_000, 100_000
#: An index with more files to a bucket than this is compacted before the next batch.
FILES_PER_BUCKET = 8
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
_WHITE = (" ", "\n", "\t", "\r", "\x0b", "\x0c")


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in _WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest (32 bytes) and number of code points of each original text."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("length"),
    )


def buckets_for(texts: int) -> int:
    """Buckets for an index that is to hold so many texts."""
    return min(MOST_BUCKETS, max(BUCKETS, math.ceil(texts / BUCKET_ROWS)))


class DigestIndex:
    """A named table of the digests seen so far: ``digest``, ``keep_id`` and the ``batch`` that brought it.

    The table's files outlive the session; opening the same name and location again continues the index, with the buckets it
    has. ``location`` is a folder that all executors share. It holds the versions of the index, named by number and buckets.
    """

    def __init__(self, spark: SparkSession, table: str, location: str, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.table, self.location, self.id_type = spark, table, location, id_type
        self._home = spark._jvm.org.apache.hadoop.fs.Path(location)
        self._files = self._home.getFileSystem(spark._jsc.hadoopConfiguration())
        self._open(max(self._versions(), default=(1, buckets)))

    def _versions(self) -> list[tuple[int, int]]:
        """(number, buckets) of the versions that were written whole."""
        if not self._files.exists(self._home):
            return []
        folders = [s.getPath() for s in self._files.listStatus(self._home) if s.isDirectory()]
        whole = [f.getName() for f in folders if self._files.exists(f.suffix("/_SUCCESS"))]
        return [tuple(map(int, name[1:].split("-"))) for name in whole]

    def _path(self, version: tuple[int, int]) -> str:
        return "{}/v{}-{}".format(self.location, *version)

    def _open(self, version: tuple[int, int]) -> None:
        self.version, self.buckets = version, version[1]
        self.close()
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {self.id_type}, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self._path(version)}'"
        )

    def close(self) -> None:
        """Take the name out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    @contextmanager
    def _sorted_scans(self) -> Iterator[None]:
        """Let Spark rely on the order within a bucket, which it does where the bucket is one file."""
        before = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_ORDERED, before)

    def _write(self, rows: DataFrame, table: str, version: tuple[int, int]) -> None:
        rows.write.bucketBy(version[1], "digest").sortBy("digest").mode("append").option("maxRecordsPerFile", 0).option(
            "path", self._path(version)
        ).saveAsTable(table)

    def compact(self, buckets: int | None = None) -> None:
        """A new version with one file to a bucket, and as many buckets as asked for; without a shuffle if they stay as many. The
        version before the current one stays for who still reads it, older ones go."""
        version, draft = (self.version[0] + 1, buckets or self.buckets), f"{self.table}_draft"
        rows = self.rows().groupBy("digest").agg(F.min(F.struct("keep_id", "batch")).alias("one")).select("digest", "one.*")
        if version[1] != self.buckets:
            rows = rows.repartition(version[1], "digest")
        self.spark.sql(f"DROP TABLE IF EXISTS {draft}")
        for left in self._left_by_dead_jobs(version[0]):
            self._files.delete(left, True)
        self._write(rows, draft, version)
        self.spark.sql(f"DROP TABLE {draft}")
        old = [v for v in self._versions() if v[0] < self.version[0]]
        self._open(version)
        for v in old:
            self._files.delete(self._home.suffix("/v{}-{}".format(*v)), True)

    def _left_by_dead_jobs(self, number: int) -> list:
        if not self._files.exists(self._home):
            return []
        folders = [s.getPath() for s in self._files.listStatus(self._home)]
        return [f for f in folders if f.getName().startswith(f"v{number}-")]

    def _many_files(self) -> bool:
        home = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(self.version))
        return self._files.exists(home) and self._files.getContentSummary(home).getFileCount() > FILES_PER_BUCKET * self.buckets

    def _add(self, batch: DataFrame, number: str) -> DataFrame:
        """Append what the batch has new; returns its digests with their numbers of rows."""
        if self._many_files():
            self.compact()
        best = F.min_by("id", F.struct((-F.col("length")).alias("n"), F.col("id").isNull().alias("no"), "id"))
        groups = batch.groupBy("digest").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        # one row per digest from here on, in the buckets of the index
        groups = materialise(groups, "groups")
        with self._sorted_scans():
            new = groups.repartition(self.buckets, "digest").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
            self._write(new.select("digest", "keep_id", F.lit(number).alias("batch")), self.table, self.version)
        return groups.select("digest", "group_size")

    def append(self, batch: DataFrame, number: str) -> DataFrame:
        """Add a batch of ``digests()``; returns one row per row of the batch: id, digest, keep_id, group_size, kept.

        A text that an earlier batch brought keeps its earlier ``keep_id``, so no row of this batch with it is kept,
        and ``group_size`` counts the rows of this batch.
        """
        return self.append_each({number: batch})

    def append_each(self, batches: dict[str, DataFrame]) -> DataFrame:
        """Add batches one after the other; returns a row per row of all of them, as ``append`` does, where ``group_size`` counts
        the rows of all."""
        rows, groups = [], []
        for number, batch in batches.items():
            rows.append(materialise(batch, "digests").withColumn("batch", F.lit(number)))
            groups.append(self._add(rows[-1].drop("batch"), number))
        sizes = reduce(DataFrame.unionByName, groups)
        if len(groups) > 1:
            sizes = sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
        known = self.rows().select("digest", "keep_id", F.col("batch").alias("brought_by"))
        with self._sorted_scans():
            seen = materialise(sizes.join(known.hint("merge"), "digest"), "seen")
        return join_groups(reduce(DataFrame.unionByName, rows), seen, ["digest"], "group_size").select(
            "id",
            "digest",
            "keep_id",
            "group_size",
            ((F.col("batch") == F.col("brought_by")) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        )
