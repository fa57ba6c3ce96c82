"""The proposed cleaning strategy, and reports on some months."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripmart.catalog import stage
from tripmart.operators import cleaning, quality, strategy
from tripmart.plans import reports

START = datetime(2024, 5, 1, 12)


def trip(**changed):
    return {
        "tpep_pickup_datetime": START, "tpep_dropoff_datetime": START + timedelta(minutes=10), "passenger_count": 1.0,
        "trip_distance": 2.0, "fare_amount": 10.0, "tip_amount": 1.0, "total_amount": 12.0,
    } | changed


def proposed(raw):
    statistics = cleaning.trip_statistics(cleaning.standardise(raw))
    return {r["finding"]: r for r in strategy.cleaning_strategy(raw, statistics).collect()}


def test_every_finding_has_an_action(spark):
    assert set(strategy.ACTIONS) == set(quality.finding_rules()) | {"extreme_fare"}


def test_actions_follow_what_is_found(make):
    rows = [trip() for _ in range(40)]
    rows += [trip(fare_amount=-5.0), trip(trip_distance=0.0), trip(tpep_dropoff_datetime=START), trip(total_amount=0.0)]
    rows += [trip(passenger_count=None) for _ in range(15)]
    found = proposed(make(rows))
    assert (found["negative_fare"]["action"], found["negative_fare"]["replacement"], found["negative_fare"]["rows_left"]) == ("impute", 10.0, 0)
    assert (found["zero_distance"]["replacement"], found["zero_distance"]["rows_left"]) == (2.0, 0)
    assert (found["nonpositive_duration"]["action"], found["nonpositive_duration"]["rows_left"]) == ("drop", 0)
    assert (found["nonpositive_total"]["action"], found["nonpositive_total"]["rows_left"]) == ("flag", 1)  # flagged, not removed
    assert found["missing_passengers"]["action"] == "investigate" and found["missing_passengers"]["rows_left"] == 0
    assert (found["null_fare"]["action"], found["null_fare"]["replacement"]) == ("none", None)


def test_no_rows(make):
    found = proposed(make([]))
    assert len(found) == len(strategy.ACTIONS)
    assert {(r["row_count"], r["pct"], r["action"], r["rows_left"]) for r in found.values()} == {(0, None, "none", 0)}


def test_what_the_strategy_settles_is_gone(spark, sf_dir):
    rows = strategy.cleaning_strategy(stage.raw_trips(spark, sf_dir), stage.statistics(spark, sf_dir)).collect()
    for r in rows:
        if r["action"] in ("impute", "replace", "cap", "drop"):
            assert r["row_count"] > 0 and r["rows_left"] == 0, r["finding"]


def test_months_are_all_that_is_read(spark, sf_dir):
    fact = stage.table(spark, sf_dir, "fact_trips")
    summer = reports.of_months(fact, 6, 7, 8)
    plan = plan_of(reports.revenue_by_period(summer))
    assert "PartitionFilters: [pickup_month" in plan and "PartitionFilters: []" not in plan
    read = summer.select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r["f"].split("pickup_month=")[1].split("/")[0]) for r in read} == {6, 7, 8}
    whole = {r["pickup_month"]: r["n"] for r in fact.groupBy("pickup_month").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert summer.count() == sum(whole[m] for m in (6, 7, 8))


def test_months_must_be_months(spark, sf_dir):
    fact = stage.table(spark, sf_dir, "fact_trips")
    for months in ((), (0,), (13,)):
        with pytest.raises(ValueError, match="months"):
            reports.of_months(fact, *months)


def test_ranks_start_anew_within_a_month(spark, sf_dir):
    rows = reports.revenue_by_period(stage.table(spark, sf_dir, "fact_trips"), "pickup_month").collect()
    by_month = {}
    for r in rows:
        by_month.setdefault(r["pickup_month"], []).append(r["revenue_rank"])
    assert all(ranks == list(range(1, len(ranks) + 1)) for ranks in by_month.values()) and len(by_month) == 12
