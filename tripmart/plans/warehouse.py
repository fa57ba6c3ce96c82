"""Warehouse job: raw trips -> star schema in Parquet -> verdict."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import modelling as M
from tripmart.operators.cleaning import clean_trips, kept_trips
from tripmart.operators.derivation import derive_columns
from tripmart.operators.quality import VERDICTS, overall, row_lineage, table_checks
from tripmart.sources.sinks import write_table
from tripmart.sources.tables import scan_table


#: What a table that is missing, truncated or no Parquet raises, depending on where Spark notices.
_UNREADABLE = (PySparkException, Py4JJavaError)


def prepared_trips(raw: DataFrame, statistics: DataFrame | None = None, method: str = "exact") -> DataFrame:
    """Cleaned trips with every derived column."""
    return clean_trips(raw, statistics, method).transform(derive_columns)


def build_warehouse(
    raw: DataFrame,
    base: str,
    method: str = "exact",
    rebalance: bool = False,
    by_year: bool = False,
    statistics: DataFrame | None = None,
) -> dict[str, int]:
    """Write the five tables below ``base`` and return their row counts.

    The raw trips are read three times, by column: fare and distance for the statistics, all used columns for the
    fact, four for ``dim_payment``. ``dim_time`` and ``dim_location`` read two columns each of the written fact.
    ``by_year`` puts the year in front of the month as a partition level. The fact is written where it is read: raw files
    that follow the months give a task one month or two. ``rebalance`` shuffles it by month first, for raw files that
    do not (every task would write every month).
    """
    spark = raw.sparkSession
    fact = M.fact_columns(prepared_trips(raw, statistics, method))
    partition_by = ["pickup_month"]
    if by_year:
        fact = fact.withColumn("pickup_year", F.year("date_key"))
        partition_by = ["pickup_year", "pickup_month"]
    counts = {
        "fact_trips": write_table(
            fact, f"{base}/fact_trips", partition_by, rebalance=rebalance, last_step=M.add_surrogate_key
        )
    }
    written = scan_table(spark, base, "fact_trips")
    dimensions = {
        "dim_time": M.dim_time(written),
        "dim_location": M.dim_location(written),
        "dim_payment": M.dim_payment(kept_trips(raw)),
        "dim_vendor": M.dim_vendor(spark),
    }
    for name, df in dimensions.items():
        counts[name] = write_table(df, f"{base}/{name}")
    return counts


def validate_warehouse(
    spark: SparkSession, base: str, expected: dict[str, int], null_severity: str = "warn"
) -> DataFrame:
    """Verdict rows for every table: count as written, no nulls in required columns.

    All tables are checked by one job, one pass each. Should that fail, every table is checked by its own job, so that
    one that cannot be read fails its check and the others go on.
    """

    def checked(name: str) -> DataFrame:
        return table_checks(scan_table(spark, base, name), name, expected.get(name), null_severity)

    def rows_of(checks: DataFrame) -> list[tuple]:
        return [tuple(row) for row in checks.collect()]  # one row per check

    def rows_or_reason(name: str) -> list[tuple]:
        try:
            return rows_of(checked(name))
        except _UNREADABLE as problem:
            reason = (str(problem).splitlines() or [type(problem).__name__])[0]
            return [(name, "readable", None, expected.get(name), None, "error", False, reason)]

    try:
        rows = rows_of(reduce(DataFrame.unionByName, [checked(name) for name in S.TABLES]))
    except _UNREADABLE:
        rows = [row for name in S.TABLES for row in rows_or_reason(name)]
    return spark.createDataFrame(rows, VERDICTS)


def run_warehouse_job(raw: DataFrame, base: str, method: str = "exact", statistics: DataFrame | None = None) -> DataFrame:
    """Build, validate and trace in one go: the lineage counts beside the overall verdict, as one row."""
    counts = build_warehouse(raw, base, method, statistics=statistics)
    verdict = overall(validate_warehouse(raw.sparkSession, base, counts))
    lineage = row_lineage(raw)
    fact_rows = F.lit(counts["fact_trips"]).cast("bigint")
    once = verdict.select(F.struct(*verdict.columns)).scalar()
    return lineage.select(
        "*",
        fact_rows.alias("fact_rows"),
        (F.col("kept_rows") == fact_rows).alias("rows_traced"),
        once["checks"].alias("checks"),
        once["errors"].alias("errors"),
        once["warnings"].alias("warnings"),
        once["all_passed"].alias("all_passed"),
    )
