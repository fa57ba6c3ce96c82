"""Cleaning rules. Each is ``DataFrame -> DataFrame``, a pure projection or filter: no shuffle, no action.

The order of :func:`clean_trips` is part of the meaning: the medians look at the raw columns, the winsorising bounds
at the fare after negative values were replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.functions.trips import duration_minutes
from tripmart.operators.quantiles import (
    Target,
    approximate_quantiles,
    coarse_counts,
    exact_quantiles,
    long_values,
    require_resolvable,
)

_TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


# --------------------------------------------------------------------------- types
def conform_types(df: DataFrame) -> DataFrame:
    """Bring the numeric columns to their working types; what does not convert becomes null instead of failing."""
    have = {f.name.lower(): f for f in df.schema.fields}
    changed = {}
    for name, wanted in S.CLEAN_TYPES.items():
        field = have.get(name.lower())
        if field is not None and field.dataType.simpleString() != wanted:
            changed[field.name] = F.col(field.name).try_cast(wanted)
    return df.withColumns(changed) if changed else df


def parse_timestamps(df: DataFrame, columns: tuple[str, ...] = S.TIMESTAMP_COLUMNS) -> DataFrame:
    """Zone-less timestamps. Already zone-less columns pass; strings must read ``yyyy-MM-dd HH:mm:ss``."""
    changed = {}
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampNTZType):
            continue
        value = F.col(name)
        if isinstance(kind, T.StringType):
            changed[name] = F.when(value.rlike(_TIMESTAMP_SHAPE), value.try_cast("timestamp_ntz"))
        else:
            changed[name] = value.cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def standardise(df: DataFrame) -> DataFrame:
    return df.transform(conform_types).transform(parse_timestamps)


# --------------------------------------------------------------------------- statistics
_FARE, _DISTANCE = "fare_amount", "trip_distance"
_LOW, _HIGH = 0.01, 0.99


def _bound_after_imputation(median: Column, plain: Column, past_negatives: Column) -> Column:
    """Order statistic of a column after its negative values were replaced by ``median``, from two of the original.

    ``plain`` is the original value at the wanted rank r, ``past_negatives`` the one at rank r + (number of negatives).
    With a non-negative median the replaced values move up to it: below the median ranks shift by their number, at and
    above it they do not. With a negative median they stay in front of every other value.
    """
    moved_up = F.when(past_negatives < median, past_negatives).otherwise(F.greatest(median, plain))
    in_front = F.when(plain < 0, median).otherwise(plain)
    return F.when(median >= 0, moved_up).otherwise(in_front)


def statistics_state(standard: DataFrame) -> DataFrame:
    """What a batch contributes to the statistics: coarse counts of fares and distances, a few hundred rows whatever its size, which
    add up over batches (``quantiles.merged_counts``)."""
    return coarse_counts(long_values(standard, [_FARE, _DISTANCE]))


def trip_statistics(
    standard: DataFrame, method: str = "exact", relative_error: float = 0.0001, state: DataFrame | None = None
) -> DataFrame:
    """One row ``fare_median, distance_median, fare_low, fare_high``; all null on empty input.

    ``exact`` takes the fare bounds after imputation from order statistics of the raw fare, so both columns are read together;
    with the merged ``state`` of all batches only once, and of that only the buckets that hold a wanted rank count. ``approximate`` runs two passes of constant-size sketches when called.
    """
    if method == "exact":
        targets = [
            Target("fare_median", _FARE, 0.5),
            Target("low_plain", _FARE, _LOW),
            Target("low_past", _FARE, _LOW, skip_negatives=True),
            Target("high_plain", _FARE, _HIGH),
            Target("high_past", _FARE, _HIGH, skip_negatives=True),
            Target("distance_median", _DISTANCE, 0.5),
        ]
        median = F.col("fare_median")
        return exact_quantiles(standard, targets, state).select(
            "fare_median",
            "distance_median",
            _bound_after_imputation(median, F.col("low_plain"), F.col("low_past")).alias("fare_low"),
            _bound_after_imputation(median, F.col("high_plain"), F.col("high_past")).alias("fare_high"),
        )
    if method == "approximate":
        for p in (_LOW, _HIGH):
            require_resolvable(p, relative_error)
        medians = approximate_quantiles(
            standard,
            [Target("fare_median", _FARE, 0.5), Target("distance_median", _DISTANCE, 0.5)],
            relative_error,
        )
        medians_once = as_scalar(medians)
        bounds = approximate_quantiles(
            impute_negative_fare(standard, medians),
            [Target("fare_low", _FARE, _LOW), Target("fare_high", _FARE, _HIGH)],
            relative_error,
        )
        return bounds.select(
            medians_once["fare_median"].alias("fare_median"),
            medians_once["distance_median"].alias("distance_median"),
            "fare_low",
            "fare_high",
        )
    raise ValueError(f"unknown method {method!r}; use 'exact' or 'approximate'")


def as_scalar(one_row: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery: evaluated once per query, and only if used."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


# --------------------------------------------------------------------------- rules
def impute_negative_fare(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """Negative fares become the median over all fares; a null fare stays null."""
    fare = F.col(_FARE)
    return df.withColumn(_FARE, F.when(fare < 0, as_scalar(statistics)["fare_median"]).otherwise(fare))


def floor_negative_tip(df: DataFrame) -> DataFrame:
    tip = F.col("tip_amount")
    return df.withColumn("tip_amount", F.when(tip < 0, F.lit(0.0)).otherwise(tip))


def flag_invalid_total(df: DataFrame) -> DataFrame:
    """Keeps the row; an unknown total gives an unknown flag."""
    return df.withColumn("is_invalid_total", F.col("total_amount") <= 0)


def fix_passengers(df: DataFrame) -> DataFrame:
    """Missing or zero becomes one passenger, more than the legal capacity becomes the capacity."""
    count = F.coalesce(F.nullif(F.col("passenger_count"), F.lit(0)), F.lit(S.DEFAULT_PASSENGERS))
    return df.withColumn("passenger_count", F.least(count, F.lit(S.MAX_PASSENGERS)))


def impute_zero_distance(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """Zero miles become the median (taken with the zeros in); null and negative distances stay."""
    miles = F.col(_DISTANCE)
    return df.withColumn(_DISTANCE, F.when(miles == 0, as_scalar(statistics)["distance_median"]).otherwise(miles))


def winsorise_fare(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """Clamp into the 1st..99th percentile. ``greatest`` skips nulls, so a null fare becomes the lower bound."""
    bounds = as_scalar(statistics)
    raised = F.greatest(F.col(_FARE), bounds["fare_low"])
    return df.withColumn(_FARE, F.least(raised, bounds["fare_high"]))


def add_duration(df: DataFrame) -> DataFrame:
    start, end = (F.col(c) for c in S.TIMESTAMP_COLUMNS)
    return df.withColumn("trip_duration_min", duration_minutes(start, end)).withColumn(
        "is_invalid_duration", F.col("trip_duration_min") <= 0
    )


def drop_invalid_duration(df: DataFrame) -> DataFrame:
    """Also drops rows whose duration is unknown; :func:`tripmart.operators.quality.row_lineage` tells them apart."""
    return df.where(~F.col("is_invalid_duration"))


def kept_trips(raw: DataFrame) -> DataFrame:
    """Rows that survive, with standard types but without the statistics-based rules (for keys and labels)."""
    return raw.transform(standardise).transform(add_duration).transform(drop_invalid_duration)


def clean_trips(raw: DataFrame, statistics: DataFrame | None = None, method: str = "exact") -> DataFrame:
    """All rules in order. ``statistics`` may be computed before and passed in."""
    standard = standardise(raw)
    if statistics is None:
        statistics = trip_statistics(standard, method)
    return (
        standard.transform(add_duration)
        .transform(drop_invalid_duration)
        .transform(impute_negative_fare, statistics)
        .transform(floor_negative_tip)
        .transform(flag_invalid_total)
        .transform(fix_passengers)
        .transform(impute_zero_distance, statistics)
        .transform(winsorise_fare, statistics)
    )
