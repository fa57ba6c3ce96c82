"""What is kept per batch or part adds up to the whole: quantile states, day bitmaps, samples; columns missing together."""

import datetime
import random

import pytest

from tests.conftest import scans_of
from tripmart import schemas as S
from tripmart.operators import profiling
from tripmart.operators.cleaning import standardise, statistics_state, trip_statistics
from tripmart.operators.quantiles import coarse_counts, long_values, merged_counts
from tripmart.plans import landing, rollups
from tripmart.sources.tables import scan_trips
from tripmart.workspace import new_path


@pytest.fixture(scope="module")
def batches(spark):
    draw = random.Random(3)

    def trip(i):
        fare = draw.choice([None, -draw.random() * 9, draw.random() * 60, draw.random() * 60, 12.5])
        return tuple({"fare_amount": fare, "trip_distance": draw.choice([None, 0.0, draw.random() * 12])}.get(f.name) for f in S.RAW_TRIPS.fields)

    return [spark.createDataFrame([trip(i) for i in range(n)], S.RAW_TRIPS) for n in (400, 1, 37, 250)]


def test_merged_states_give_the_statistics_of_all_batches(spark, batches):
    states = [statistics_state(standardise(b)) for b in batches]
    whole = batches[0]
    merged = states[0]
    for batch, state in zip(batches[1:], states[1:], strict=True):
        whole, merged = whole.unionAll(batch), merged.unionAll(state)
    standard = standardise(whole)
    assert trip_statistics(standard, state=merged_counts(merged)).collect() == trip_statistics(standard).collect()
    columns = ["fare_amount", "trip_distance"]
    plain = {(r.measure, r.bucket): r for r in coarse_counts(long_values(standard, columns)).collect()}
    added = merged_counts(merged).collect()
    assert len(added) == len(plain)
    for r in added:
        other = plain[r.measure, r.bucket]
        assert (r.n, r.negatives, r.low, r.high) == (other.n, other.negatives, other.low, other.high)
        assert r["mean"] == pytest.approx(other["mean"]) and r.variance == pytest.approx(other.variance, abs=1e-9)


def test_a_state_is_replaced_with_its_batch(spark, batches):
    zone = new_path(spark, "zone")
    for month, batch in ((4, batches[0]), (5, batches[2]), (5, batches[3])):
        landing.land_trips(batch, zone, 2026, month)
        landing.keep_state(spark, zone, 2026, month)
    trips = standardise(scan_trips(spark, zone))
    state = landing.zone_state(spark, landing.state_path(zone))
    assert trip_statistics(trips, state=state).collect() == trip_statistics(trips).collect()


def test_with_a_state_trips_are_read_once(spark, batches):
    zone = new_path(spark, "zone")
    landing.land_trips(batches[0], zone, 2026, 4)
    landing.keep_state(spark, zone, 2026, 4)
    trips = standardise(scan_trips(spark, zone))
    state = spark.createDataFrame(landing.zone_state(spark, landing.state_path(zone)).collect(), statistics_state(trips).schema)
    assert scans_of(trip_statistics(trips, state=state)) < scans_of(trip_statistics(trips))


def test_no_trips(spark, batches):
    nothing = standardise(batches[0].limit(0))
    assert trip_statistics(nothing, state=merged_counts(statistics_state(nothing))).collect() == trip_statistics(nothing).collect()


def test_active_days_of_any_groups(spark):
    draw = random.Random(8)
    first = datetime.date(1969, 12, 1)  # days before 1970, and far apart
    rows = [
        (draw.randrange(6), first + datetime.timedelta(days=draw.choice([draw.randrange(60), draw.randrange(60_000)])), draw.choice([True, False, None]))
        for _ in range(2000)
    ]
    fact = spark.createDataFrame(rows, "pickup_location_id bigint, date_key date, is_invalid_total boolean").selectExpr("*", "month(date_key) AS pickup_month")
    bits = rollups.day_bitmaps(fact)
    valid = [(zone, day) for zone, day, invalid in rows if invalid is False]
    by_zone = {r.pickup_location_id: r.active_days for r in rollups.active_days(bits, "pickup_location_id").collect()}
    assert by_zone == {z: len({d for zone, d in valid if zone == z}) for z in {z for z, _ in valid}}
    by_year = {r.pickup_year: r.active_days for r in rollups.active_days(bits, "pickup_year").collect()}
    assert by_year == {y: len({d for _, d in valid if d.year == y}) for y in {d.year for _, d in valid}}
    assert rollups.active_days(rollups.day_bitmaps(fact.limit(0)), "pickup_location_id").count() == 0


@pytest.mark.parametrize("rows", [0, 1, 37, 300, 10_000])
def test_samples_do_not_depend_on_the_layout(spark, rows):
    df = spark.range(3000).selectExpr("id % 700 AS id", "IF(id % 3 = 0, NULL, 'x') AS hash")
    one, other = (sorted(map(tuple, profiling.bottom_sample(d, rows).collect()), key=str) for d in (df.coalesce(1), df.repartition(9)))
    assert one == other and len(one) == min(rows, 3000)


def test_samples_of_parts_merge_into_that_of_the_whole(spark):
    df = spark.range(2000).selectExpr("id", "id * 7 AS v")
    parts = profiling.bottom_sample(df.where("id % 2 = 0"), 50).unionAll(profiling.bottom_sample(df.where("id % 2 = 1"), 50))
    assert sorted(profiling.bottom_sample(parts, 50).collect()) == sorted(profiling.bottom_sample(df, 50).collect())


def test_columns_missing_together(spark):
    df = spark.createDataFrame([(None, 1, None), (None, None, 2), (3, None, None), (None, 4, None)], "a int, `b c` int, d int")
    found = {(r.column_a, r.column_b): (r.both_missing, r.share) for r in profiling.missing_together(df).collect()}
    assert len(found) == 9 and found["a", "a"] == (3, 75.0)
    assert found["a", "d"] == found["d", "a"] == (2, 50.0) and found["a", "b c"] == (1, 25.0) and found["b c", "d"] == (1, 25.0)
    assert {r.both_missing for r in profiling.missing_together(df.limit(0)).collect()} == {0}
    with pytest.raises(ValueError):
        profiling.missing_together(df, ["a"] * 64)
