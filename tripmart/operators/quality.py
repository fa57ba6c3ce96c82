"""Data-quality measures: one aggregation pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.numeric import rounded, share_pct
from tripmart.operators.cleaning import add_duration, standardise

VERDICTS = (
    "table_name string, check_name string, column_name string, expected bigint, observed bigint, "
    "severity string, passed boolean, error string"
)


def row_lineage(raw: DataFrame) -> DataFrame:
    """Raw, kept and dropped rows, with the two reasons for dropping told apart. Reads the two timestamps only."""
    minutes = F.col("trip_duration_min")
    counted = add_duration(standardise(raw)).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(minutes > 0).alias("kept_rows"),
        F.count_if(minutes <= 0).alias("dropped_invalid"),
        F.count_if(minutes.isNull()).alias("dropped_unknown"),
    )
    dropped = F.col("dropped_invalid") + F.col("dropped_unknown")
    return counted.withColumns(
        {"dropped_rows": dropped, "dropped_pct": rounded(share_pct(dropped, F.col("raw_rows")))}
    )


def finding_rules() -> dict[str, Column]:
    """What each finding means, over standard trips with their duration."""
    c = F.col
    return {
        "negative_fare": c("fare_amount") < 0,
        "null_fare": c("fare_amount").isNull(),
        "negative_tip": c("tip_amount") < 0,
        "nonpositive_total": c("total_amount") <= 0,
        "null_total": c("total_amount").isNull(),
        "missing_passengers": c("passenger_count").isNull() | (c("passenger_count") == 0),
        "negative_passengers": c("passenger_count") < 0,
        "too_many_passengers": c("passenger_count") > S.MAX_PASSENGERS,
        "zero_distance": c("trip_distance") == 0,
        "negative_distance": c("trip_distance") < 0,
        "null_distance": c("trip_distance").isNull(),
        "nonpositive_duration": c("trip_duration_min") <= 0,
        "unknown_duration": c("trip_duration_min").isNull(),
    }


def count_findings(trips: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``all_rows, finding, row_count``, in one pass."""
    counted = trips.agg(F.count(F.lit(1)).alias("all_rows"), *[F.count_if(p).alias(n) for n, p in rules.items()])
    return counted.unpivot(["all_rows"], list(rules), "finding", "row_count")


def dq_findings(raw: DataFrame) -> DataFrame:
    """How many rows each cleaning rule acts on, and the oddities that are kept on purpose."""
    long = count_findings(add_duration(standardise(raw)), finding_rules())
    return long.select("finding", "row_count", rounded(share_pct(F.col("row_count"), F.col("all_rows"))).alias("pct"))


def table_checks(df: DataFrame, name: str, expected: int | None, null_severity: str = "warn") -> DataFrame:
    """Row count and null assertions of one table in a single pass. Required columns it lacks are skipped."""
    required = [c for c in S.REQUIRED_COLUMNS.get(name, ()) if c in df.columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in required],
    )

    def verdict(check: str, column: str | None, wanted: int | None, seen: str, severity: str):
        want = F.lit(wanted).cast("bigint")
        return F.struct(
            F.lit(name).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).cast("string").alias("column_name"),
            want.alias("expected"),
            F.col(seen).alias("observed"),
            F.lit(severity).alias("severity"),
            F.coalesce(F.col(seen) == want, F.lit(False)).alias("passed"),
            F.lit(None).cast("string").alias("error"),
        )

    rows = [verdict("row_count", None, expected, "_rows", "error")]
    rows += [verdict("not_null", c, 0, f"_null_{c}", null_severity) for c in required]
    return counted.select(F.inline(F.array(*rows)))


def overall(verdicts: DataFrame) -> DataFrame:
    """One row: every check of severity ``error`` passed, and how many checks failed at each severity."""
    failed, severe = ~F.col("passed"), F.col("severity") == "error"
    return verdicts.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(failed & severe).alias("errors"),
        F.count_if(failed & ~severe).alias("warnings"),
        F.coalesce(F.bool_and(F.col("passed") | ~severe), F.lit(True)).alias("all_passed"),
    )
