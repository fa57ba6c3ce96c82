"""Partial aggregates of the fact that several reports share.

One scan of the fact fills several grains by grouping sets: per group the number of trips, and of each measure its sum and how many
values are known. Such rows add up, so a report may read any grain that has its keys, and gives what it gives on the fact
itself. ``scan_rollup`` picks the grain: the first that covers the wanted columns, small ones standing in front. Grains of few rows are
filled together; one that may have as many rows as the fact is filled on its own: grouping sets would shuffle it with the keys of all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURES = ("total_amount", "fare_amount", "tip_pct", "trip_duration_min", "trip_distance")
#: Keys of each grain, from the fewest rows to the most: periods and vendors, distances and payments, days, zones by day.
GRAINS = {
    "hour": ("time_of_day", "pickup_hour", "is_weekend", "vendor_id", "is_invalid_total"),
    "distance": ("distance_bucket", "payment_key"),
    "day": ("date_key", "pickup_month", "pickup_dow", "is_airport_trip", "is_invalid_total"),
    "zone_day": ("pickup_location_id", "date_key", "pickup_month", "is_invalid_total"),
}


#: Grains that are filled by one scan.
TOGETHER = (("hour", "distance", "day"), ("zone_day",))


def _measures() -> list:
    return [x for m in MEASURES for x in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_known"))]


def rollups(fact: DataFrame, grains: tuple[str, ...] = tuple(GRAINS)) -> DataFrame:
    """``grain``, the keys of all grains (null where a grain lacks them), ``trips`` and sums and counts of the measures."""
    keys = list(dict.fromkeys(k for grain in GRAINS.values() for k in grain))
    partial = ["trips", *[f"{m}_{x}" for m in MEASURES for x in ("sum", "known")]]
    if len(grains) == 1:
        own = GRAINS[grains[0]]
        kinds = {f.name: f.dataType for f in fact.schema.fields}
        grouped = fact.groupBy(*own).agg(F.count(F.lit(1)).alias("trips"), *_measures())
        named = [F.col(k) if k in own else F.lit(None).cast(kinds[k]).alias(k) for k in keys]
        return grouped.select(F.lit(grains[0]).alias("grain"), *named, *partial)
    # grouping_id has a bit per key, the first one highest, set where the key is not part of the grain
    bits = {name: reduce(lambda bits, k: 2 * bits + (k not in grain), keys, 0) for name, grain in GRAINS.items()}
    grain = reduce(lambda out, item: out.when(F.col("of") == item[1], F.lit(item[0])), bits.items(), F.when(F.lit(False), F.lit("")))
    grouped = fact.groupingSets([[F.col(k) for k in GRAINS[g]] for g in grains], *[F.col(k) for k in keys])
    return grouped.agg(F.grouping_id().alias("of"), F.count(F.lit(1)).alias("trips"), *_measures()).select(grain.alias("grain"), *keys, *partial)


def build_rollups(fact: DataFrame, path: str, grains: tuple[str, ...] | None = None) -> None:
    """Write grains, all unless told otherwise, a folder each."""
    groups = [grains] if grains else TOGETHER
    for n, group in enumerate(groups):
        rollups(fact, group).write.mode("append" if n else "overwrite").partitionBy("grain").parquet(path)


def grain_of(*columns: str) -> str:
    """The smallest grain that has the columns."""
    for name, keys in GRAINS.items():
        if set(columns) <= set(keys):
            return name
    raise ValueError(f"no grain has all of {columns}")


def scan_rollup(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The smallest grain that has the columns."""
    name = grain_of(*columns)
    partial = ["trips", *[f"{m}_{x}" for m in MEASURES for x in ("sum", "known")]]
    return spark.read.parquet(path).where(F.col("grain") == name).select(*GRAINS[name], *partial)


# ------------------------------------------------------------------ distinct days that add up
def day_bitmaps(fact: DataFrame) -> DataFrame:
    """``pickup_location_id, pickup_year, pickup_month, block, days``: the days of a zone's valid trips as bits, a number per zone and
    calendar month (``block``, months since year 0). Distinct days cannot be added up over groups; bits can be merged."""
    valid = fact.where(F.col("is_invalid_total") == F.lit(False)).where(F.col("date_key").isNotNull())
    year = F.year("date_key")
    block = (year * 12 + F.month("date_key") - 1).cast("bigint").alias("block")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("date_key") - 1)
    return valid.groupBy("pickup_location_id", year.alias("pickup_year"), "pickup_month", block).agg(F.bit_or(bit).alias("days"))


def active_days(bitmaps: DataFrame, *keys) -> DataFrame:
    """Days with a trip per group of any keys made from the zone, year and month."""
    merged = bitmaps.groupBy(*keys, "block").agg(F.bit_or("days").alias("days"))
    names = [c for c in merged.columns if c not in ("block", "days")]
    return merged.groupBy(*names).agg(F.sum(F.bit_count("days").cast("bigint")).alias("active_days"))
