"""Removal of passages by overlapping windows of three lines.

Every three consecutive lines of a document are hashed to 128 bits. A window that occurs more than once in the corpus stays
at its first occurrence, by (id, position); a line is removed if any later occurrence of a window covers it. Overlapping
covered stretches merge, so a repeated passage of n lines goes as a whole. Windows of three blank lines do not count.

Only hashes and positions are shuffled to find repeats; they combine per task first, and windows that a large share of
the corpus has are joined without a shuffle of their rows. Texts are shuffled once, to meet the positions, in a
sort-merge join at every size: the positions grow with the corpus. Rebuilding a text
slices its lines between covered stretches, in time linear in the text.

Null texts stay null; texts of fewer than three lines stay. Ids that are null come first. Documents of one id with different
texts are told apart by a hash of the text; rows with the same id and the same text count as one document given several
times and keep the same lines. An empty table gives an empty table. Extra columns stay; ``lines_removed`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import join_groups
from tripmart.workspace import materialise

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per window: id, text_hash, pos (of its first line, from 0), and the halves of its hash."""
    lines = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), _lines(F.col(text_col)).alias("lines")
    )
    cut = lines.where(F.size("lines") >= WINDOW).select(
        "id", "text_hash", F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("lines") - WINDOW),
                lambda i: F.struct(i.alias("pos"), *[F.get("lines", i + k).alias(f"l{k}") for k in range(WINDOW)]),
            )
        ).alias("w"),
    )
    line = [F.col(f"w.l{k}") for k in range(WINDOW)]
    return cut.where(F.concat(*line).rlike(r"[^\x20\x09-\x0D]")).select(
        "id",
        "text_hash",
        F.col("w.pos").alias("pos"),
        F.xxhash64(*line).alias("hash_a"),
        F.xxhash64(F.lit(1), *line[::-1]).alias("hash_b"),
    )


def later_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash and starts: the sorted positions of windows that occur before in the corpus."""
    found = materialise(windows(docs, id_col, text_col), "windows")
    place = F.struct("id", "text_hash", "pos")
    groups = materialise(
        found.groupBy("hash_a", "hash_b")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1"),
        "repeated",
    )
    later = join_groups(found, groups, ["hash_a", "hash_b"], "occurrences").where(
        F.col("first").isNotNull() & (place != F.col("first"))
    )
    # a struct with a null id compares as not null, so documents without id take part
    return later.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def _kept(lines: Column, starts: Column) -> Column:
    """The lines outside the stretches of WINDOW lines that begin at the sorted starts."""
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(starts)),
        lambda i: F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get(starts, i - 1) + WINDOW).alias("begin"),
            F.when(i == F.size(starts), F.size(lines)).otherwise(F.get(starts, i)).alias("end"),
        ),
    )
    return F.flatten(
        F.transform(
            F.filter(gaps, lambda g: g["end"] > g["begin"]),
            lambda g: F.slice(lines, g["begin"] + 1, g["end"] - g["begin"]),
        )
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with shortened texts, and ``lines_removed``."""
    later = materialise(later_occurrences(docs, id_col, text_col), "later")
    names = [c for c in docs.columns if c != "lines_removed"]
    # the user's columns in one struct: none can have the name of a working column
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"), F.xxhash64(text_col).alias("_hash"))
    joined = rows.join(
        later.alias("l").hint("merge"),
        F.col(f"d.{id_col}").eqNullSafe(F.col("l.id")) & (F.col("_hash") == F.col("l.text_hash")),
        "left",
    )
    split = joined.withColumn("_lines", F.when(F.col("l.starts").isNotNull(), _lines(F.col(f"d.{text_col}"))))
    kept = split.withColumn("_kept", _kept(F.col("_lines"), F.col("l.starts")))
    text = F.when(F.col("l.starts").isNull(), F.col(f"d.{text_col}")).otherwise(F.array_join("_kept", "\n"))
    removed = F.when(F.col("l.starts").isNull(), F.lit(0)).otherwise(F.size("_lines") - F.size("_kept"))
    return kept.select(
        *[text.alias(c) if c == text_col else F.col("d").getField(c).alias(c) for c in names], removed.alias("lines_removed")
    )
