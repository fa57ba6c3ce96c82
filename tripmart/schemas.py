"""Schemas and fixed business vocabulary, declared once.

Everything below that is upper-case data is a *fixed value*: results are only right if it is exactly this.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw zone: one row per trip, as published by the meter vendors
# ---------------------------------------------------------------------------
RAW_TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

# Types the cleaning step works on; a raw column of another type is converted with TRY_CAST.
CLEAN_TYPES = {
    "passenger_count": "int",
    "RatecodeID": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}
TIMESTAMP_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")

# Revenue = fare + these, in this order (double addition is not associative).
SURCHARGES = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# ---------------------------------------------------------------------------
# Labels (fixed values)
# ---------------------------------------------------------------------------
# first hour, last hour (inclusive), label
PERIODS = (
    (6, 9, "Morning Rush"),
    (10, 15, "Midday"),
    (16, 19, "Evening Rush"),
    (20, 23, "Night"),
)
OTHER_PERIOD = "Late Night"

# exclusive upper bound in miles, label; the last bucket also takes unknown distances
DISTANCE_BUCKETS = (
    (1.0, "< 1 mi"),
    (3.0, "1–3 mi"),
    (5.0, "3–5 mi"),
    (10.0, "5–10 mi"),
)
LONGEST_BUCKET = "> 10 mi"
BUCKET_ORDER = tuple(label for _, label in DISTANCE_BUCKETS) + (LONGEST_BUCKET,)

PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
RATE_LABELS = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated",
    6: "Group Ride",
}
UNKNOWN = "Unknown"
VENDORS = {1: "Creative Mobile Technologies", 2: "VeriFone Inc."}

AIRPORT_RATE_CODES = (2, 3)
WEEKEND_DAYS = (1, 7)  # Spark's dayofweek: 1 = Sunday, 7 = Saturday
REPORTED_PAYMENTS = ("Credit Card", "Cash")
MAX_PASSENGERS = 6
DEFAULT_PASSENGERS = 1

# ---------------------------------------------------------------------------
# Warehouse
# ---------------------------------------------------------------------------
# cleaned column -> fact column, in table order; the surrogate key comes first
FACT_COLUMNS = (
    ("pickup_date", "date_key"),
    ("PULocationID", "pickup_location_id"),
    ("DOLocationID", "dropoff_location_id"),
    ("payment_type", "payment_key"),
    ("VendorID", "vendor_id"),
    ("trip_distance", "trip_distance"),
    ("trip_duration_min", "trip_duration_min"),
    ("passenger_count", "passenger_count"),
    ("fare_amount", "fare_amount"),
    ("tip_amount", "tip_amount"),
    ("tip_pct", "tip_pct"),
    ("tolls_amount", "tolls_amount"),
    ("total_amount", "total_amount"),
    ("revenue_excl_tip", "revenue_excl_tip"),
    ("congestion_surcharge", "congestion_surcharge"),
    ("airport_fee", "airport_fee"),
    ("time_of_day", "time_of_day"),
    ("is_weekend", "is_weekend"),
    ("is_airport_trip", "is_airport_trip"),
    ("is_invalid_total", "is_invalid_total"),
    ("distance_bucket", "distance_bucket"),
    ("pickup_hour", "pickup_hour"),
    ("pickup_month", "pickup_month"),
    ("pickup_dow", "pickup_dow"),
)
FACT_TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.LongType()),
        T.StructField("date_key", T.DateType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
        T.StructField("payment_key", T.LongType()),
        T.StructField("vendor_id", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("trip_duration_min", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tip_pct", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("revenue_excl_tip", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("time_of_day", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_airport_trip", T.BooleanType()),
        T.StructField("is_invalid_total", T.BooleanType()),
        T.StructField("distance_bucket", T.StringType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_month", T.IntegerType()),
        T.StructField("pickup_dow", T.IntegerType()),
    ]
)
TABLES = ("fact_trips", "dim_time", "dim_location", "dim_payment", "dim_vendor")

# key columns that should not be null, per table
REQUIRED_COLUMNS = {
    "fact_trips": ("date_key", "pickup_location_id", "fare_amount", "total_amount"),
    "dim_time": ("date_key", "hour"),
    "dim_location": ("location_id",),
    "dim_payment": ("payment_key",),
    "dim_vendor": ("vendor_id",),
}

# ---------------------------------------------------------------------------
# Landing gates (fixed values)
# ---------------------------------------------------------------------------
ALLOWED_EXTENSIONS = ("csv", "parquet", "json", "tsv")
MIN_FILE_BYTES = 10 * 1024 * 1024
MIN_ROWS = 500_000
