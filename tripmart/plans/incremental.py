"""A warehouse that takes in one landed batch after the other.

The fact is kept by month of pickup, each month a published table of its own, so that a batch replaces the months it touches and carries
the others over by their path. Which months those are follows from the rules: a trip's row depends on the other trips through four
numbers only, the medians and bounds of the zone. A new batch brings its own trips, and may move the four numbers. They reach a trip
only if a value of it is replaced or clamped: a negative fare, a distance of zero, a fare below or above the bounds, the old
ones or the new ones. Months that have such a trip are written again, all others stay as they are.

Statistics come from the states kept per batch, so a batch costs one filtered scan of the zone for them, and reads of the months
to write. Dimensions grow by the keys they lack (anti-join). What is published is what a full rebuild over all batches gives, apart from
the surrogate ids, which are unique but different.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import modelling as M
from tripmart.operators.cleaning import kept_trips, standardise, trip_statistics
from tripmart.plans.landing import keep_state, land_trips, state_path, zone_state
from tripmart.plans.publish import Published, Version
from tripmart.plans.warehouse import prepared_trips
from tripmart.sources.sinks import write_table
from tripmart.sources.tables import scan_trips

_PICKUP = S.TIMESTAMP_COLUMNS[0]
_FACT = "fact_month"
_BOUNDS = ("fare_median", "distance_median", "fare_low", "fare_high")
#: A month's ids begin here times its number: a job numbers its rows below this.
_IDS = 1 << 59


@dataclass(frozen=True)
class Step:
    """What taking in a batch did: the version, the months written, and those carried over."""

    version: Version
    written: tuple[int, ...]
    carried: tuple[int, ...]


def _statistics(spark: SparkSession, zone: str) -> DataFrame:
    state = zone_state(spark, state_path(zone))
    return trip_statistics(standardise(scan_trips(spark, zone)), state=state)


def _reached(old: DataFrame, new: DataFrame) -> Column:
    """Does a change of the statistics reach a trip?"""
    before, after = (d.select(F.struct(*_BOUNDS)).scalar() for d in (old, new))
    fare, distance = F.col("fare_amount"), F.col("trip_distance")

    def moved(name: str) -> Column:
        return ~before[name].eqNullSafe(after[name])

    # a fare that is missing becomes the lower bound; a negative one the median
    imputed = (moved("fare_median") & (fare < 0)) | (moved("distance_median") & (distance == 0))
    low = moved("fare_low") & (fare.isNull() | (fare < F.greatest(before["fare_low"], after["fare_low"])))
    high = moved("fare_high") & (fare > F.least(before["fare_high"], after["fare_high"]))
    # the median that replaces a fare may itself lie outside the bounds
    clamped = (moved("fare_low") | moved("fare_high")) & (fare < 0)
    return F.coalesce(imputed, F.lit(False)) | F.coalesce(low, F.lit(False)) | F.coalesce(high, F.lit(False)) | F.coalesce(clamped, F.lit(False))


def _months(trips: DataFrame) -> list[int]:
    rows = trips.select(F.month(_PICKUP).alias("m")).where("m IS NOT NULL").distinct().collect()  # twelve at most
    return sorted(r.m for r in rows)


def fact(warehouse: Published, number: int | None = None) -> DataFrame:
    """All months of a version."""
    version = warehouse.version(number)
    paths = [f"{warehouse.base}/{path}" for name, path in sorted(version.paths.items()) if name.startswith(f"{_FACT}=")]
    schema = S.FACT_TRIPS
    return warehouse.spark.read.schema(schema).parquet(*paths) if paths else warehouse.spark.createDataFrame([], schema)


def take_in(batch: DataFrame, zone: str, warehouse: Published, year: int, month: int) -> Step:
    """Land a batch under its load date, for the first time, and publish the warehouse of all batches so far."""
    spark = batch.sparkSession
    before = warehouse.version()
    first = before.number == 0
    old = None if first else spark.createDataFrame(_statistics(spark, zone).collect(), ", ".join(f"{b} double" for b in _BOUNDS))
    fresh = land_trips(batch, zone, year, month)
    keep_state(spark, zone, year, month)
    new = spark.createDataFrame(_statistics(spark, zone).collect(), ", ".join(f"{b} double" for b in _BOUNDS))  # one row
    trips = scan_trips(spark, zone)
    kept_before = {int(name.split("=")[1]) for name in before.paths if name.startswith(f"{_FACT}=")}
    changed = set(_months(fresh))
    if not first:
        changed |= set(_months(standardise(trips).where(_reached(old, new))))

    def write(folder: str) -> dict[str, int]:
        rows = {}
        if changed:  # all months by one scan of the zone
            wanted = F.month(_PICKUP).isin(*changed)
            of_months = M.fact_columns(prepared_trips(trips.where(wanted), new)).withColumn(_FACT, F.col("pickup_month"))
            numbered = lambda df: df.select((F.monotonically_increasing_id() + F.col(_FACT) * F.lit(_IDS)).alias("trip_id"), "*")
            write_table(of_months, folder, [_FACT], last_step=numbered)
            there = spark.read.schema(f"{_FACT} int").parquet(folder)
            counted = {r[_FACT]: r["count"] for r in there.groupBy(_FACT).count().collect()}  # twelve at most
            for number in sorted(changed):
                name = f"{_FACT}={number}"
                rows[name] = counted.get(number, 0)
                if not rows[name]:  # a month without rows has no folder yet
                    write_table(spark.createDataFrame([], S.FACT_TRIPS), f"{folder}/{name}")
        written = [f"{folder}/{_FACT}={number}" for number in sorted(changed)]
        new_fact = spark.read.schema(S.FACT_TRIPS).parquet(*written) if written else spark.createDataFrame([], S.FACT_TRIPS)
        found = {
            "dim_time": M.dim_time(new_fact),
            "dim_location": M.dim_location(new_fact),
            "dim_payment": M.dim_payment(kept_trips(fresh)),
            "dim_vendor": M.dim_vendor(spark),
        }
        for name, df in found.items():
            if name in before.paths:
                there = warehouse.read(name, before.number)
                same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in df.columns]
                lacking = df.alias("a").join(there.alias("b"), same, "left_anti")
                if name == "dim_vendor" or lacking.isEmpty():
                    continue  # carried over
                df = there.unionByName(lacking)
            rows[name] = write_table(df, f"{folder}/{name}")
        return rows

    folder = warehouse.begin()
    version = warehouse.publish(folder, write(folder), before.number)
    return Step(version, tuple(sorted(changed)), tuple(sorted(kept_before - changed)))
