"""Star schema: one fact table and four dimensions.

Dimensions are made from as few columns as determine them: first the distinct keys (with map-side combine), then the
attributes of each key. ``dim_time`` and ``dim_location`` are read off the written fact table, ``dim_payment`` needs
the rate code, which the fact does not carry, and comes from the kept raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import trips as X


def fact_columns(clean: DataFrame) -> DataFrame:
    """The fact table without its surrogate key."""
    return clean.select(*[F.col(source).alias(target) for source, target in S.FACT_COLUMNS])


def add_surrogate_key(df: DataFrame) -> DataFrame:
    """Unique ``trip_id``, not stable between runs. Apply it after the last shuffle before a write, so that a task
    that runs again replaces its own ids."""
    return df.select(F.monotonically_increasing_id().alias("trip_id"), "*")


def fact_trips(clean: DataFrame) -> DataFrame:
    return add_surrogate_key(fact_columns(clean))


def dim_time(fact: DataFrame) -> DataFrame:
    """One row per date and hour that has a trip."""
    day, hour = F.col("date_key"), F.col("hour")
    return (
        fact.select("date_key", F.col("pickup_hour").alias("hour"))
        .distinct()
        .select(
            "date_key",
            "hour",
            F.dayofweek(day).alias("day_of_week"),
            F.month(day).alias("month"),
            F.weekofyear(day).alias("week_of_year"),
            X.period_of_day(hour).alias("time_of_day"),
            X.weekend_flag(F.dayofweek(day)).alias("is_weekend"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
        )
    )


def dim_location(fact: DataFrame) -> DataFrame:
    """One row per zone and role. Both roles come from one scan."""
    roles = F.array(
        F.struct(F.col("pickup_location_id").alias("location_id"), F.lit("pickup").alias("location_type")),
        F.struct(F.col("dropoff_location_id").alias("location_id"), F.lit("dropoff").alias("location_type")),
    )
    return fact.select(F.inline(roles)).distinct()


def dim_payment(kept: DataFrame) -> DataFrame:
    """One row per payment type *and* rate code: ``payment_key`` alone does not identify a row."""
    keys = kept.select(F.col("payment_type").alias("payment_key"), F.col("RatecodeID").alias("rate_code")).distinct()
    return keys.select(
        "payment_key",
        X.code_label(F.col("payment_key"), S.PAYMENT_LABELS).alias("payment_label"),
        X.code_label(F.col("rate_code"), S.RATE_LABELS).alias("rate_label"),
        "rate_code",
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    """Two fixed rows, as an inline table (its size is known to the optimizer)."""
    rows = ", ".join(f"({key}L, '{name}')" for key, name in S.VENDORS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(vendor_id, vendor_name)")
