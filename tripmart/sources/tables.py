"""Readers: raw trips, warehouse tables, CSV; row counts and schema reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S


def conform_trips(df: DataFrame) -> DataFrame:
    """A batch in the declared raw schema: columns found by name in any case, values converted where they can be (else
    null), absent columns null, others left out. Publishers change names and types from month to month."""
    found = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{found[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in found else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in S.RAW_TRIPS.fields
        ]
    )


def scan_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed raw trips, in the declared schema (no inference, and nothing to infer from is no error); partition columns
    of the path follow."""
    return spark.read.schema(S.RAW_TRIPS).parquet(*paths)


def scan_table(spark: SparkSession, base: str, name: str, by_year: bool = False) -> DataFrame:
    """A warehouse table. A partitioned write of no rows leaves no file to take the schema from: the fact table then
    has its declared one, with the year if it was written ``by_year``."""
    path = f"{base}/{name}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if name != "fact_trips" or problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        schema = T.StructType(S.FACT_TRIPS.fields)
        return spark.read.schema(schema.add("pickup_year", T.IntegerType()) if by_year else schema).parquet(path)


def scan_warehouse(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: scan_table(spark, base, name) for name in S.TABLES}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to SQL text under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema (no inference pass over the data)."""
    return (
        spark.read.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("enforceSchema", False)
        .schema(schema)
        .csv(path)
    )


def csv_sample(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """Header and first rows of a CSV, all as strings: a look at an unknown file."""
    return spark.read.option("header", True).csv(path).limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, declared type, and how many values are set. One aggregation pass."""
    fields = df.schema.fields
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_set_{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                F.col(f"_set_{i}").alias("non_null"),
                (F.col(f"_set_{i}") < F.col("_rows")).alias("has_nulls"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counted.select(F.inline(rows))
