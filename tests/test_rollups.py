"""Reports read partial aggregates as they read trips."""

import pytest

from tests.conftest import plan_of, scans_of
from tripmart.catalog import stage
from tripmart.plans import reports, rollups
from tripmart.workspace import new_path


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    fact, payments, times, vendors = (stage.table(spark, sf_dir, n) for n in ("fact_trips", "dim_payment", "dim_time", "dim_vendor"))
    return {
        ("time_of_day", "is_invalid_total"): reports.revenue_by_period,
        ("distance_bucket", "payment_key"): lambda t: reports.tip_by_distance(t, payments),
        ("pickup_hour", "is_weekend"): reports.hourly_demand,
        ("pickup_location_id", "date_key", "is_invalid_total"): reports.top_zones,
        ("pickup_month", "pickup_dow", "is_airport_trip", "is_invalid_total"): reports.airport_trend,
        ("date_key", "is_airport_trip", "is_invalid_total"): lambda t: reports.airport_iso_weeks(t, times),
        ("vendor_id",): lambda t: reports.vendor_revenue(t, vendors),
    }, fact


def test_reports_are_those_of_the_trips(spark, sf_dir, tables):
    of, fact = tables
    for columns, report in of.items():
        partial = report(stage.rollup(spark, sf_dir, *columns))
        assert partial.collect() == report(fact).collect(), columns
        assert partial.schema.simpleString() == report(fact).schema.simpleString()


def test_all_grains_come_from_one_scan_of_the_fact(spark, tables):
    assert scans_of(rollups.rollups(tables[1])) == 1


def test_the_smallest_grain_that_covers_is_read(spark, sf_dir):
    plan = plan_of(stage.rollup(spark, sf_dir, "is_invalid_total"))
    assert "grain" in plan and "= hour" in plan and "PartitionFilters: []" not in plan
    assert "zone_day" in plan_of(stage.rollup(spark, sf_dir, "pickup_location_id"))
    with pytest.raises(ValueError):
        stage.rollup(spark, sf_dir, "pickup_location_id", "vendor_id")


def test_no_trips(spark, tables):
    path = new_path(spark, "no-rollups")
    fact = tables[1].limit(0)
    empty = rollups.rollups(fact)
    assert empty.count() == 0
    empty.write.partitionBy("grain").parquet(path)
    assert reports.hourly_demand(empty).count() == 0
