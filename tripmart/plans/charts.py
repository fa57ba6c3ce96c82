"""Tables that feed charts. Each is built on a report, so a chart can never disagree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.numeric import rounded, share_pct

CHART_ZONES = 10


def hourly_series(hourly: DataFrame) -> DataFrame:
    """Two series over the hours of the day: trips on weekdays and at weekends."""
    return (
        hourly.groupBy("pickup_hour")
        .pivot("is_weekend", [False, True])
        .agg(F.sum("trip_count"))
        .select("pickup_hour", F.col("false").alias("weekday_trips"), F.col("true").alias("weekend_trips"))
        .orderBy("pickup_hour")
    )


def period_bars(periods: DataFrame) -> DataFrame:
    """Revenue in millions and average fare per part of the day."""
    return periods.select(
        "revenue_rank", "time_of_day", (F.col("total_revenue") / 1e6).alias("revenue_millions"), "avg_fare"
    ).orderBy("revenue_rank", "time_of_day")


def tip_heatmap(tips: DataFrame) -> DataFrame:
    """Average tip by distance (rows, shortest first) and payment type (columns)."""
    order = F.array_position(F.array(*[F.lit(b) for b in S.BUCKET_ORDER]), F.col("distance_bucket"))
    return (
        tips.groupBy("distance_bucket")
        .pivot("payment_label", list(S.REPORTED_PAYMENTS))
        .agg(F.avg("avg_tip_pct"))
        .select(
            order.cast("int").alias("bucket_order"),
            "distance_bucket",
            F.col("Credit Card").alias("credit_card"),
            F.col("Cash").alias("cash"),
        )
        .orderBy("bucket_order")
    )


def zone_bars(zones: DataFrame) -> DataFrame:
    """The first ten zones."""
    return (
        zones.orderBy("revenue_rank", "pickup_location_id")
        .limit(CHART_ZONES)
        .select("pickup_location_id", "avg_daily_revenue", "revenue_rank")
    )


def payment_share(tips: DataFrame) -> DataFrame:
    """Share of the reported trips per payment type, in percent."""
    per_label = tips.groupBy("payment_label").agg(F.sum("trip_count").alias("trip_count"))
    everything = F.sum("trip_count").over(Window.partitionBy())
    return per_label.select(
        "payment_label", "trip_count", rounded(share_pct(F.col("trip_count"), everything)).alias("share_pct")
    ).orderBy("payment_label")


def airport_means(trend: DataFrame) -> DataFrame:
    """Airport and city trips: plain mean of the group averages (not weighted); unknown kinds are left out."""
    kind = F.when(F.col("is_airport_trip"), F.lit("Airport Trip")).otherwise(F.lit("City Trip"))
    return (
        trend.where(F.col("is_airport_trip").isNotNull())
        .groupBy(kind.alias("trip_kind"))
        .agg(rounded(F.avg("avg_fare")).alias("avg_fare"), rounded(F.avg("avg_distance")).alias("avg_distance"))
        .orderBy("trip_kind")
    )


def tip_by_period(periods: DataFrame) -> DataFrame:
    return periods.select("revenue_rank", "time_of_day", "avg_tip_pct").orderBy("revenue_rank", "time_of_day")


def rank_scatter(zones: DataFrame) -> DataFrame:
    """Rank against revenue in thousands, the mark sized by active days."""
    return (
        zones.orderBy("revenue_rank", "pickup_location_id")
        .limit(CHART_ZONES)
        .select(
            "pickup_location_id",
            "revenue_rank",
            (F.col("total_revenue") / 1000.0).alias("revenue_thousands"),
            (F.col("active_days") * 3).alias("mark_size"),
        )
    )
