"""Business reports over the warehouse. Each takes tables and returns a sorted DataFrame; collecting is up to the caller.

A report reads trips or partial aggregates of them (``rollups``), whichever it is given: sums of sums and of counts are
those of the trips. Where a report needs a dimension, trips are aggregated by the join key first: the join then sees one row per key, not
one per trip, whatever the size or skew of the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.numeric import pct_change, rounded
from tripmart.operators.joins import reported_payment_labels, with_time, with_vendor

TOP_ZONES = 15


def _valid(fact: DataFrame) -> DataFrame:
    """Only trips known to have a valid total: an unknown flag is left out as well."""
    return fact.where(F.col("is_invalid_total") == F.lit(False))


def _is_partial(rows: DataFrame) -> bool:
    return "trips" in rows.columns


def _count(rows: DataFrame) -> Column:
    return F.sum("trips") if _is_partial(rows) else F.count(F.lit(1))


def _sum(rows: DataFrame, column: str) -> Column:
    return F.sum(f"{column}_sum") if _is_partial(rows) else F.sum(column)


def _known(rows: DataFrame, column: str) -> Column:
    return F.sum(f"{column}_known") if _is_partial(rows) else F.count(column)


def _mean(rows: DataFrame, column: str, alias: str) -> Column:
    return rounded(_sum(rows, column) / F.nullif(_known(rows, column), F.lit(0))).alias(alias)


def of_months(rows: DataFrame, *months: int) -> DataFrame:
    """Trips, or partial aggregates by month, of these months of pickup, for any report. The fact lies in a folder per month, so the others
    are not read."""
    if not months or not all(1 <= m <= 12 for m in months):
        raise ValueError(f"months are numbers from 1 to 12, not {months}")
    return rows.where(F.col("pickup_month").isin(*months))


def revenue_by_period(fact: DataFrame, *within: str) -> DataFrame:
    """Revenue, fare, tip and duration by part of the day, ranked by revenue, over all trips or within each value of other keys."""
    per_period = _valid(fact).groupBy(*within, "time_of_day").agg(
        _count(fact).alias("trip_count"),
        _sum(fact, "total_amount").alias("_revenue"),
        _mean(fact, "fare_amount", "avg_fare"),
        _mean(fact, "tip_pct", "avg_tip_pct"),
        _mean(fact, "trip_duration_min", "avg_duration_min"),
    )
    ranked = per_period.withColumn("revenue_rank", F.rank().over(Window.partitionBy(*within).orderBy(F.desc("_revenue"))))
    return ranked.select(
        *within,
        "time_of_day",
        "trip_count",
        rounded(F.col("_revenue")).alias("total_revenue"),
        "avg_fare",
        "avg_tip_pct",
        "avg_duration_min",
        "revenue_rank",
    ).orderBy(*within, "revenue_rank", "time_of_day")


def tip_by_distance(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """Average tip by distance and payment type (card and cash), numbered within the payment type."""
    per_key = fact.groupBy("distance_bucket", "payment_key").agg(
        _count(fact).alias("trips"),
        _sum(fact, "tip_pct").alias("tips"),
        _known(fact, "tip_pct").alias("tips_known"),
        _sum(fact, "fare_amount").alias("fares"),
        _known(fact, "fare_amount").alias("fares_known"),
    )
    per_label = (
        per_key.join(reported_payment_labels(payments), "payment_key")
        .groupBy("distance_bucket", "payment_label")
        .agg(
            (F.sum("tips") / F.nullif(F.sum("tips_known"), F.lit(0))).alias("_tip"),
            F.sum("trips").alias("trip_count"),
            rounded(F.sum("fares") / F.nullif(F.sum("fares_known"), F.lit(0))).alias("avg_fare"),
        )
    )
    best_first = Window.partitionBy("payment_label").orderBy(F.desc("_tip"), "distance_bucket")
    return (
        per_label.withColumn("top_tipping_rank_within_payment", F.row_number().over(best_first))
        .select(
            "distance_bucket",
            "payment_label",
            rounded(F.col("_tip")).alias("avg_tip_pct"),
            "trip_count",
            "avg_fare",
            "top_tipping_rank_within_payment",
        )
        .orderBy("payment_label", F.desc("avg_tip_pct"), "distance_bucket")
    )


def top_tipping_band(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """The best-tipping distance of each payment type."""
    return tip_by_distance(fact, payments).where(F.col("top_tipping_rank_within_payment") == 1)


def hourly_demand(fact: DataFrame) -> DataFrame:
    """Volume and revenue by hour, weekdays against weekends; all trips."""
    return (
        fact.groupBy("pickup_hour", "is_weekend")
        .agg(
            _count(fact).alias("trip_count"),
            _mean(fact, "fare_amount", "avg_fare"),
            _mean(fact, "trip_duration_min", "avg_duration"),
            rounded(_sum(fact, "total_amount")).alias("total_revenue"),
        )
        .orderBy("pickup_hour", "is_weekend")
    )


def top_zones(fact: DataFrame, limit: int = TOP_ZONES) -> DataFrame:
    """Pickup zones by average daily revenue. Ties share a rank, so there can be more than ``limit`` rows."""
    per_day = _valid(fact).groupBy("pickup_location_id", "date_key").agg(_sum(fact, "total_amount").alias("day_revenue"))
    # (zone, day) is unique here, so counting days needs no DISTINCT
    per_zone = per_day.groupBy("pickup_location_id").agg(
        F.avg("day_revenue").alias("_daily"),
        F.sum("day_revenue").alias("_total"),
        F.count("date_key").alias("active_days"),
    )
    ranked = per_zone.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("_daily"))))
    return (
        ranked.where(F.col("revenue_rank") <= limit)
        .select(
            "pickup_location_id",
            rounded(F.col("_daily")).alias("avg_daily_revenue"),
            rounded(F.col("_total")).alias("total_revenue"),
            "active_days",
            "revenue_rank",
        )
        .orderBy("revenue_rank", "pickup_location_id")
    )


def _with_previous(per_period: DataFrame, period: list[str]) -> DataFrame:
    """Revenue of the previous row of the same trip kind, and the change against it."""
    history = Window.partitionBy("is_airport_trip").orderBy(*period)
    return per_period.withColumn("prev_period_revenue", F.lag("total_revenue").over(history)).withColumn(
        "revenue_pct_change", rounded(pct_change(F.col("total_revenue"), F.col("prev_period_revenue")))
    )


def airport_trend(fact: DataFrame) -> DataFrame:
    """Airport against city trips by month and day of week; trips of unknown kind form a third group."""
    per_day = _valid(fact).groupBy("pickup_month", F.col("pickup_dow").alias("day_of_week"), "is_airport_trip").agg(
        _count(fact).alias("trip_count"),
        _mean(fact, "fare_amount", "avg_fare"),
        _mean(fact, "trip_distance", "avg_distance"),
        _mean(fact, "tip_pct", "avg_tip_pct"),
        rounded(_sum(fact, "total_amount")).alias("total_revenue"),
    )
    return _with_previous(per_day, ["pickup_month", "day_of_week"]).orderBy(
        F.desc("is_airport_trip"), "pickup_month", "day_of_week"
    )


def airport_iso_weeks(fact: DataFrame, times: DataFrame) -> DataFrame:
    """The same trend on true ISO weeks, taken from ``dim_time`` on its real grain."""
    measures = ("fare_amount", "trip_distance", "tip_pct")
    hour = [] if _is_partial(fact) else ["pickup_hour"]  # partial aggregates by day: a day lies in one week
    per_hour = _valid(fact).groupBy("date_key", *hour, "is_airport_trip").agg(
        _count(fact).alias("trips"),
        _sum(fact, "total_amount").alias("revenue"),
        *[_sum(fact, c).alias(f"{c}_sum") for c in measures],
        *[_known(fact, c).alias(f"{c}_known") for c in measures],
    )
    weeks = times.select("date_key", "week_of_year").distinct()
    iso_year = F.expr("extract(YEAROFWEEK FROM date_key)")

    def mean(column: str, alias: str) -> Column:
        return rounded(F.sum(f"{column}_sum") / F.nullif(F.sum(f"{column}_known"), F.lit(0))).alias(alias)

    per_week = (
        (with_time(per_hour, times, ["week_of_year"]) if hour else per_hour.join(weeks, "date_key", "left"))
        .groupBy(iso_year.alias("iso_year"), "week_of_year", "is_airport_trip")
        .agg(
            F.sum("trips").alias("trip_count"),
            mean("fare_amount", "avg_fare"),
            mean("trip_distance", "avg_distance"),
            mean("tip_pct", "avg_tip_pct"),
            rounded(F.sum("revenue")).alias("total_revenue"),
        )
    )
    return _with_previous(per_week, ["iso_year", "week_of_year"]).orderBy(
        F.desc("is_airport_trip"), "iso_year", "week_of_year"
    )


def vendor_revenue(fact: DataFrame, vendors: DataFrame) -> DataFrame:
    """Revenue by vendor name; trips of vendors without a name share a null group."""
    per_id = fact.groupBy("vendor_id").agg(_sum(fact, "total_amount").alias("revenue"))
    return (
        with_vendor(per_id, vendors)
        .groupBy("vendor_name")
        .agg(rounded(F.sum("revenue")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "vendor_name")
    )


def preview(report: DataFrame, rows: int = 20) -> DataFrame:
    """First rows of a sorted report."""
    return report.limit(rows)
