import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, scans_of
from tripmart.operators import profiling as P

VALUES = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 40.0]


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(v, None if v > 3 else "x") for v in VALUES] + [(None, "y")], "v double, s string")


def test_stats(numbers):
    row = P.numeric_stats(numbers, ["v"]).first()
    assert (row["n"], row["median"], row["min"], row["max"]) == (7, 3.0, 1.0, 40.0)
    assert row["mean"] == round(statistics.mean(VALUES), 2) and row["std"] == round(statistics.stdev(VALUES), 2)


def test_missing(numbers):
    assert {r[0]: (r[1], r[2]) for r in P.missing_values(numbers).collect()} == {"v": (1, 12.5), "s": (3, 37.5)}
    blocks = P.missing_matrix(numbers, F.coalesce(F.col("v"), F.lit(0.0)) > 3, ["s"]).collect()
    assert {r["block"]: r["missing_pct"] for r in blocks} == {True: 100.0, False: 0.0}


def test_histogram_counts_every_value_once(numbers):
    rows = P.histogram(numbers, ["v"], bins=4).collect()
    assert sum(r["n"] for r in rows) == len(VALUES)
    assert {r["bin"]: r["n"] for r in rows} == {1: 6, 4: 1}


def test_density_integrates_to_about_one(numbers):
    rows = P.kernel_density(numbers, ["v"], bins=64).orderBy("point").collect()
    assert len(rows) == 64
    width = rows[1]["x"] - rows[0]["x"]
    assert 0.5 < sum(r["density"] for r in rows) * width < 1.05
    assert "NestedLoop" not in plan_of(P.kernel_density(numbers, ["v"]))


def test_constant_and_empty_columns(spark):
    constant = spark.createDataFrame([(6.55,)] * 5, "v double")
    assert P.kernel_density(constant, ["v"]).count() == 0
    assert [tuple(r)[1:] for r in P.histogram(constant, ["v"]).collect()] == [(1, 6.55, 6.55, 5)]
    empty = constant.limit(0)
    assert P.histogram(empty, ["v"]).count() == 0 and P.outliers(empty, ["v"]).count() == 0
    row = P.numeric_stats(empty, ["v"]).first()
    assert (row["n"], row["median"]) == (0, None)
    assert P.duplicate_summary(empty).first().asDict() == {"total_rows": 0, "distinct_rows": 0, "duplicate_groups": 0, "surplus_rows": 0}


def test_outliers(numbers):
    row = P.outliers(numbers, ["v"]).first()
    assert (row["q1"], row["q3"], row["below"], row["above"]) == (2.0, 5.0, 0, 1)


def test_duplicates_of_a_hot_row(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"))
    assert P.duplicate_summary(df).first().asDict() == {"total_rows": 9000, "distinct_rows": 6001, "duplicate_groups": 1, "surplus_rows": 2999}
    assert [tuple(r) for r in P.duplicate_rows(df).collect()] == [(0, "x", 3000)]
    assert P.duplicate_summary(df, ["b"]).first()["distinct_rows"] == 1


def test_duplicates_do_not_depend_on_the_hash(spark):
    df = spark.range(600).select((F.col("id") % 400).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    colliding = (F.pmod(F.col("a"), F.lit(7)), F.lit(0))
    assert P.duplicate_summary(df, hashes=colliding).first() == P.duplicate_summary(df).first()
    assert sorted(map(tuple, P.duplicate_rows(df, hashes=colliding).collect())) == sorted(map(tuple, P.duplicate_rows(df).collect()))
    assert P.duplicate_summary(df).first().asDict() == {"total_rows": 600, "distinct_rows": 400, "duplicate_groups": 200, "surplus_rows": 200}


def test_all_rows_are_grouped_by_hashes_only(spark, sf_dir):
    from tripmart.catalog.stage import raw_trips

    plan = P.duplicate_summary(raw_trips(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_a" in plan


@pytest.mark.parametrize(("profile", "most"), [(P.numeric_stats, 3), (P.outliers, 3), (P.kernel_density, 3), (P.histogram, 2)])
def test_scans_of_a_profile(spark, sf_dir, profile, most):
    from tripmart.catalog.stage import raw_trips

    assert scans_of(profile(raw_trips(spark, sf_dir), ["fare_amount", "trip_distance"])) <= most


def test_sample_is_bounded_and_small_tables_come_back_whole(spark):
    assert P.profile_sample(spark.range(500), rows=1000).count() == 500
    assert all(P.profile_sample(spark.range(20_000), rows=100, seed=s).count() == 100 for s in range(12))
    assert P.profile_sample(spark.range(0), rows=10).count() == 0
