from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.functions import trips as X
from tripmart.functions.numeric import pct_change, rounded
from tripmart.operators import derivation as D
from tripmart import schemas as S


@pytest.mark.parametrize(
    "hour,label",
    [(0, "Late Night"), (5, "Late Night"), (6, "Morning Rush"), (9, "Morning Rush"), (10, "Midday"), (15, "Midday"),
     (16, "Evening Rush"), (19, "Evening Rush"), (20, "Night"), (23, "Night"), (None, "Late Night")],
)
def test_period_edges(spark, hour, label):
    df = spark.createDataFrame([(hour,)], "h int")
    assert df.select(X.period_of_day(F.col("h"))).first()[0] == label


@pytest.mark.parametrize(
    "miles,label",
    [(0.99, "< 1 mi"), (1.0, "1–3 mi"), (3.0, "3–5 mi"), (5.0, "5–10 mi"), (10.0, "> 10 mi"), (None, "> 10 mi"), (-1.0, "< 1 mi")],
)
def test_bucket_edges(spark, miles, label):
    df = spark.createDataFrame([(miles,)], "d double")
    assert df.select(X.distance_bucket(F.col("d"))).first()[0] == label


@pytest.mark.parametrize(
    "rate,fee,flag",
    [(2, None, True), (3, 0.0, True), (1, 1.25, True), (1, 0.0, False), (1, None, None), (None, 0.0, None), (None, 1.0, True)],
)
def test_airport_flag_is_three_valued(spark, rate, fee, flag):
    df = spark.createDataFrame([(rate, fee)], "r int, f double")
    assert df.select(X.airport_flag(F.col("r"), F.col("f"))).first()[0] is flag


def test_calendar_of_a_sunday_in_iso_week_52(make):
    row = D.add_calendar(make([{"tpep_pickup_datetime": datetime(2023, 1, 1, 23)}])).first()
    assert (row["pickup_dow"], row["pickup_week"], row["pickup_month"], row["pickup_hour"], row["is_weekend"]) == (1, 52, 1, 23, True)


def test_labels(spark):
    df = spark.createDataFrame([(1, 99), (5, None), (None, 6), (2**40, 4)], "payment_type bigint, RatecodeID int")
    rows = [tuple(r) for r in D.add_labels(df).select("payment_label", "rate_label").collect()]
    assert rows == [("Credit Card", "Unknown"), ("Unknown", "Unknown"), ("Unknown", "Group Ride"), ("Unknown", "Nassau/Westchester")]


def test_rounding_is_decimal_half_up_and_survives_large_sums(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (5e13 + 0.25,), (1e35,), (None,), (float("inf"),)], "x double")
    got = [r[0] for r in df.select(rounded(F.col("x"))).collect()]
    assert got == [1.01, -1.01, 5e13 + 0.25, 1e35, None, float("inf")]


def test_tip_percent_and_revenue(spark):
    df = spark.createDataFrame([(1.0, 8.0), (1.0, 0.0), (1.0, None), (None, 8.0)], "t double, f double")
    assert [r[0] for r in df.select(X.tip_percent(F.col("t"), F.col("f"))).collect()] == [12.5, 0.0, 0.0, None]
    df = spark.createDataFrame([(10.0, None, 2), (None, 1.0, 1)], "f double, a double, b int")
    revenue = X.revenue_without_tip(F.col("f"), [F.col("a"), F.col("b")])
    assert [r[0] for r in df.select(revenue).collect()] == [12.0, None]


def test_change_against_nothing_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (6.0, 4.0)], "v double, p double")
    assert [r[0] for r in df.select(pct_change(F.col("v"), F.col("p"))).collect()] == [None, None, 50.0]


def test_fact_has_the_documented_columns(make):
    from tripmart.operators.modelling import fact_trips
    from tripmart.plans.warehouse import prepared_trips

    fact = fact_trips(prepared_trips(make([])))
    assert len(fact.columns) == 25 and fact.columns[0] == "trip_id"
    assert fact.columns[1:] == [target for _, target in S.FACT_COLUMNS]
    assert fact.dtypes == [(f.name, f.dataType.simpleString()) for f in S.FACT_TRIPS.fields]
