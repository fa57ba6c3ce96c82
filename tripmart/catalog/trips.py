"""Trip records derived from the order tables, with defects injected by rule (see FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def derived_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trip per order line. A sort-merge join on the order key, as both tables grow; adaptive execution splits a hot order."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    ).hint("merge")
    k = F.col("k")
    price = F.col("l_extendedprice")
    nothing = F.lit(None).cast("double")
    keyed = lines.withColumn(
        "k", 7 * F.col("l_orderkey") + 13 * F.col("l_partkey") + 31 * F.col("l_linenumber").cast("bigint")
    )

    def every(n: int):
        return k % n == 0

    def minutes_after_midnight(minutes):
        return F.timestamp_add("MINUTE", minutes.cast("int"), F.col("o_orderdate"))

    ride = F.when(every(41), -1).when(every(43), 0).otherwise(1 + k % 90)
    return keyed.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(6)
        .cast("bigint").alias("VendorID"),
        F.when(~every(97), minutes_after_midnight(k % 1440)).alias("tpep_pickup_datetime"),
        minutes_after_midnight(k % 1440 + ride).alias("tpep_dropoff_datetime"),
        F.when(every(29), nothing).when(every(23), 0).when(every(31), 9).otherwise(1 + k % 4)
        .cast("double").alias("passenger_count"),
        F.when(every(101), nothing).when(every(37), 0.0).otherwise(F.col("l_quantity") * 0.3).alias("trip_distance"),
        F.when(every(67), nothing).when(every(71), 99).otherwise(1 + k % 6).cast("double").alias("RatecodeID"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("o_custkey") % 265).alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
        F.when(every(103), nothing).when(every(53), -price / 1000).otherwise(price / 1000).alias("fare_amount"),
        F.when(every(17), nothing).otherwise((k % 3).cast("double") * 0.5).alias("extra"),
        F.when(every(19), nothing).otherwise(0.5).alias("mta_tax"),
        F.when(every(59), -1.0).otherwise(price * F.col("l_discount") / 1000).alias("tip_amount"),
        F.when(every(13), 6.55).alias("tolls_amount"),
        F.when(every(47), nothing).otherwise(1.0).alias("improvement_surcharge"),
        F.when(every(61), 0.0).when(every(107), nothing).otherwise(price * (1 + F.col("l_tax")) / 1000)
        .alias("total_amount"),
        F.when(~every(7), 2.5).alias("congestion_surcharge"),
        F.when(every(10), 1.25).when(every(11), nothing).otherwise(0.0).alias("airport_fee"),
    )
