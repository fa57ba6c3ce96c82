"""Joins of the fact table with its dimensions.

No side carries a broadcast hint. The optimizer broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold``, which holds for the two vendor rows and for dimensions of usual size, and
falls back to a shuffled join (with adaptive skew handling) above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S


def with_vendor(fact: DataFrame, vendors: DataFrame) -> DataFrame:
    """Left join: trips of an unknown vendor keep a null name."""
    return fact.join(vendors, "vendor_id", "left")


def payment_labels(payments: DataFrame) -> DataFrame:
    """``dim_payment`` reduced to one row per payment key, so that a join on it cannot multiply trips."""
    return payments.select("payment_key", "payment_label").distinct()


def reported_payment_labels(payments: DataFrame) -> DataFrame:
    return payment_labels(payments.where(F.col("payment_label").isin(*S.REPORTED_PAYMENTS)))


def with_time(df: DataFrame, times: DataFrame, columns: list[str]) -> DataFrame:
    """Join on date *and* hour, the real grain of ``dim_time``."""
    right = times.select("date_key", F.col("hour").alias("pickup_hour"), *columns)
    return df.join(right, ["date_key", "pickup_hour"])


def with_location_roles(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """``dim_location`` joined in both of its roles; adds the role names found."""

    def role(name: str, key: str) -> DataFrame:
        return locations.where(F.col("location_type") == name).select(
            F.col("location_id").alias(key), F.col("location_type").alias(f"{name}_role")
        )

    return fact.join(role("pickup", "pickup_location_id"), "pickup_location_id").join(
        role("dropoff", "dropoff_location_id"), "dropoff_location_id"
    )
