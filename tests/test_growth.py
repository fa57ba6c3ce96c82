"""What is shuffled or read does not grow with keys that a report has no use for."""

from tests.conftest import plan_of
from tripmart.catalog import stage
from tripmart.catalog.queries import QUERIES
from tripmart.catalog.trips import derived_trips
from tripmart.plans import incremental, rollups


def test_months_meet_counts_not_trips(spark, sf_dir):
    plan = plan_of(QUERIES["land_raw"](spark, sf_dir))
    join = plan[plan.index("Join") :]
    assert join.index("HashAggregate") < join.index("FileScan")


def test_orders_are_not_broadcast_when_small(spark, sf_dir):
    assert "SortMergeJoin" in plan_of(derived_trips(spark, sf_dir))


def test_hourly_report_fills_no_grain_of_zones(spark, sf_dir, monkeypatch):
    filled = []
    monkeypatch.setattr(stage, "_rollups", {})
    monkeypatch.setattr(stage, "build_rollups", lambda fact, path, grains: (filled.extend(grains), rollups.build_rollups(fact, path, grains)))
    assert QUERIES["q3_hourly_demand"](spark, sf_dir).count() == 48
    assert filled == ["hour", "distance", "day"]


def test_a_grain_of_its_own_has_the_rows_of_grouping_sets(spark, sf_dir):
    fact = stage.table(spark, sf_dir, "fact_trips")
    keys = ["grain", "pickup_location_id", "date_key", "pickup_month", "is_invalid_total", "vendor_id", "trips", "tip_pct_known"]
    own, every = rollups.rollups(fact, ("zone_day",)), rollups.rollups(fact).where("grain = 'zone_day'")
    assert own.schema.simpleString() == every.schema.simpleString() and own.count() > 0
    assert own.select(keys).exceptAll(every.select(keys)).count() == 0 == every.select(keys).exceptAll(own.select(keys)).count()


def test_days_of_a_zone_and_month_are_one_number(spark, sf_dir):
    bits = rollups.day_bitmaps(stage.table(spark, sf_dir, "fact_trips"))
    assert bits.schema["days"].dataType.simpleString() == "bigint" and bits.where("days <= 0").count() == 0


def test_months_are_written_by_one_scan(spark, sf_dir, monkeypatch):
    calls = []
    write = incremental.write_table
    monkeypatch.setattr(incremental, "write_table", lambda df, path, *a, **b: (calls.append(path), write(df, path, *a, **b))[1])
    rows = QUERIES["etl_incremental"](spark, sf_dir).count()
    assert rows == stage.table(spark, sf_dir, "fact_trips").count()
    assert len([c for c in calls if "dim_" not in c]) == 3  # a batch, one write
