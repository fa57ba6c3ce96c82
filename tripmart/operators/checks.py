"""Verdict rows: ``check_name, observed, required, passed``. Checks are collected first, then judged once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S


class GateFailed(ValueError):
    """At least one gate check failed; the message lists all of them."""


def check_row(df: DataFrame, name: str, observed: Column, required: int, at_least: bool = True) -> DataFrame:
    """Reduce ``df`` to one verdict row. A null aggregate (no input) counts as zero."""
    seen = F.coalesce(observed.cast("bigint"), F.lit(0).cast("bigint"))
    row = df.agg(seen.alias("observed"))
    limit = F.lit(required).cast("bigint")
    passed = F.col("observed") >= limit if at_least else F.col("observed") <= limit
    return row.select(F.lit(name).alias("check_name"), "observed", limit.alias("required"), passed.alias("passed"))


def row_gate(df: DataFrame, min_rows: int = S.MIN_ROWS) -> DataFrame:
    return check_row(df, "row_count", F.count(F.lit(1)), min_rows)


def ingest_gate(
    files: DataFrame,
    rows: DataFrame,
    min_rows: int = S.MIN_ROWS,
    encodings: DataFrame | None = None,
) -> DataFrame:
    """All landing checks as one table. ``files`` is the result of the file gate, ``encodings`` of the UTF-8 check; ``rows``
    has a row per format, with its number of rows ``n`` and whether it is ``readable``."""
    parts = [
        check_row(files, "files_present", F.count(F.lit(1)), 1),
        check_row(files, "bad_extensions", F.count_if(~F.col("extension_ok")), 0, at_least=False),
        check_row(files, "small_files", F.count_if(~F.col("size_ok")), 0, at_least=False),
        check_row(rows, "unreadable", F.count_if(~F.col("readable")), 0, at_least=False),
        check_row(rows, "row_count", F.sum("n"), min_rows),
    ]
    if encodings is not None:
        parts.append(check_row(encodings, "not_utf8", F.count_if(~F.col("is_utf8")), 0, at_least=False))
    return reduce(DataFrame.unionByName, parts)


def require_passed(checks: DataFrame) -> None:
    """Raise once, naming every failed check (a table of checks has a handful of rows)."""
    failed = checks.where(~F.col("passed")).orderBy("check_name").collect()
    if failed:
        lines = [f"{r['check_name']}: observed {r['observed']}, required {r['required']}" for r in failed]
        raise GateFailed(f"{len(failed)} check(s) failed: " + "; ".join(lines))
