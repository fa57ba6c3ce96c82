"""Derived columns of a cleaned trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import trips as X


def add_calendar(df: DataFrame) -> DataFrame:
    """Hour, day of week (1 = Sunday), month, date and ISO week of the pickup, and the weekend flag."""
    at = F.col("tpep_pickup_datetime")
    return df.withColumns(
        {
            "pickup_hour": F.hour(at),
            "pickup_dow": F.dayofweek(at),
            "pickup_month": F.month(at),
            "pickup_date": F.to_date(at),
            "pickup_week": F.weekofyear(at),
            "is_weekend": X.weekend_flag(F.dayofweek(at)),
        }
    )


def add_time_of_day(df: DataFrame) -> DataFrame:
    return df.withColumn("time_of_day", X.period_of_day(F.hour("tpep_pickup_datetime")))


def add_airport_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_airport_trip", X.airport_flag(F.col("RatecodeID"), F.col("airport_fee")))


def add_tip_percent(df: DataFrame) -> DataFrame:
    return df.withColumn("tip_pct", X.tip_percent(F.col("tip_amount"), F.col("fare_amount")))


def add_revenue(df: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in S.SURCHARGES]
    return df.withColumn("revenue_excl_tip", X.revenue_without_tip(F.col("fare_amount"), parts))


def add_distance_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_bucket", X.distance_bucket(F.col("trip_distance")))


def add_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "payment_label": X.code_label(F.col("payment_type"), S.PAYMENT_LABELS),
            "rate_label": X.code_label(F.col("RatecodeID"), S.RATE_LABELS),
        }
    )


def derive_columns(df: DataFrame) -> DataFrame:
    """Every derived column; what a later step does not read is pruned from the plan."""
    for step in (
        add_calendar,
        add_time_of_day,
        add_airport_flag,
        add_tip_percent,
        add_revenue,
        add_distance_bucket,
        add_labels,
    ):
        df = df.transform(step)
    return df
