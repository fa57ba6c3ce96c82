import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripmart.operators.cleaning import impute_negative_fare, trip_statistics
from tripmart.operators.quantiles import Target, approximate_quantiles, exact_quantiles, require_resolvable

PROBABILITIES = {"p0": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
TARGETS = [Target(name, "x", p) for name, p in PROBABILITIES.items()]


def discrete(values, p):
    ordered = sorted(values)
    hundredths = round(p * 100)
    return ordered[max(1, -(-len(ordered) * hundredths // 100)) - 1]


def run(spark, values, targets=TARGETS):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return exact_quantiles(df, targets).collect()[0].asDict()


@pytest.mark.parametrize(
    "values",
    [
        [float(i) for i in range(1, 101)],
        [3.5],
        [-1.0, -2.0, -3.0, 0.0, 2.0],
        [7.0] * 50 + [1.0],
        [1e-300, 1e300, -1e300, 0.1, 0.2],
        [float("inf"), 1.0, float("-inf")],
        [1_000_000_000.0 + i / 7 for i in range(300)],
        [i * 1e-9 for i in range(500)],
        [40.0 + i * 7.1e-15 for i in range(400)] + [40.01],
        [5e-324, -5e-324, 1e-310, 0.0, -0.0, 1.7e308],
    ],
)
def test_exact_equals_sorted_list(spark, values):
    found = run(spark, values)
    assert found == {name: discrete(values, p) for name, p in PROBABILITIES.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=60))
def test_exact_on_arbitrary_doubles(spark, values):
    assert run(spark, values) == {name: discrete(values, p) for name, p in PROBABILITIES.items()}


def test_nulls_and_nan_are_ignored_and_empty_gives_null(spark):
    assert run(spark, [None, float("nan"), 4.0])["p50"] == 4.0
    assert set(run(spark, []).values()) == {None}
    assert set(run(spark, [None, None]).values()) == {None}


def _fares(make, fares):
    return make([{"fare_amount": f, "trip_distance": 1.0} for f in fares])


@pytest.mark.parametrize(
    "fares",
    [
        [-5.0, 1.0, 2.0, 3.0],
        [-5.0] * 3 + [1.0],  # median itself negative
        [-1.0, -2.0, -3.0],
        [0.0, 0.0, -0.5, 9.0],
        [float(i) for i in range(-40, 160)],
        [1.0] * 30 + [-2.0] * 20 + [50.0] * 10,
    ],
)
def test_bounds_after_imputation_come_from_the_raw_fares(make, fares):
    """The bounds read off raw order statistics equal those of the imputed column."""
    df = _fares(make, fares)
    row = trip_statistics(df).collect()[0]
    median = discrete(fares, 0.5)
    imputed = [median if f < 0 else f for f in fares]
    assert row["fare_median"] == median
    assert row["fare_low"] == discrete(imputed, 0.01)
    assert row["fare_high"] == discrete(imputed, 0.99)


def test_error_as_wide_as_the_tail_is_refused(spark):
    """With error 0.01 the 1st percentile of 0..100000 may come back as the minimum."""
    df = spark.range(100_001).select(F.col("id").cast("double").alias("x"))
    assert df.approxQuantile("x", [0.01, 0.99], 0.01) == [0.0, 100_000.0]
    with pytest.raises(ValueError):
        require_resolvable(0.01, 0.01)
    with pytest.raises(ValueError):
        approximate_quantiles(df, [Target("p", "x", 0.99)], 0.02)
    exact = exact_quantiles(df, [Target("lo", "x", 0.01), Target("hi", "x", 0.99)]).collect()[0]
    assert (exact["lo"], exact["hi"]) == (1000.0, 99_000.0)
    sketch = approximate_quantiles(df, [Target("lo", "x", 0.01), Target("hi", "x", 0.99)], 0.0005).collect()[0]
    assert math.isclose(sketch["lo"], 1000.0, abs_tol=51) and math.isclose(sketch["hi"], 99_000.0, abs_tol=51)


def test_approximate_statistics_stay_within_their_rank_error(spark, sf_dir):
    from tripmart.catalog.stage import raw_trips

    raw = raw_trips(spark, sf_dir)
    exact, sketch = trip_statistics(raw).collect()[0], trip_statistics(raw, "approximate", 0.001).collect()[0]
    n = raw.where("fare_amount IS NOT NULL").count()
    imputed = impute_negative_fare(raw, trip_statistics(raw))
    for name in ("fare_low", "fare_high"):
        low, high = sorted((exact[name], sketch[name]))
        between = imputed.where((F.col("fare_amount") > low) & (F.col("fare_amount") < high)).count()
        assert between <= 0.002 * n + 1
    assert trip_statistics(raw.limit(0), "approximate").collect()[0]["fare_low"] is None
    with pytest.raises(ValueError):
        trip_statistics(raw, "approximate", 0.01)
    with pytest.raises(ValueError):
        trip_statistics(raw, "guess")


def test_a_hot_value_is_combined_before_the_shuffle_and_no_value_list_is_built(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 52.0).otherwise(F.col("id") / 7.0).alias("x"))
    quantiles = exact_quantiles(hot, TARGETS)
    values = [52.0 if i % 3 == 0 else i / 7.0 for i in range(30_000)]
    assert quantiles.collect()[0].asDict() == {n: discrete(values, p) for n, p in PROBABILITIES.items()}
    plan = plan_of(quantiles)
    assert "partial_count" in plan
    assert "percentile" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_statistics_run_once_as_a_subquery(make):
    df = make([{"fare_amount": 5.0, "tpep_pickup_datetime": datetime(2023, 1, 1)}])
    stats = trip_statistics(df)
    from tripmart.operators.cleaning import winsorise_fare

    out = impute_negative_fare(df, stats).transform(winsorise_fare, stats)
    out.collect()
    assert "ReusedSubquery" in plan_of(out)
    # not reading the imputed column drops the statistics from the plan
    assert "ubquery" not in plan_of(out.select("PULocationID"))


def test_two_scans(spark, sf_dir):
    from tests.conftest import scans_of
    from tripmart.catalog.stage import raw_trips

    assert scans_of(trip_statistics(raw_trips(spark, sf_dir))) == 2
