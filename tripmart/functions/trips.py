"""Column expressions of the trip domain. All are built-in expressions and stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.numeric import rounded


def code_label(code: Column, labels: dict[int, str], default: str = S.UNKNOWN) -> Column:
    """Label of an integer code; unknown and null codes get ``default``."""
    pairs = [part for key, label in labels.items() for part in (F.lit(key), F.lit(label))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.try_cast("int")), F.lit(default))


def period_of_day(hour: Column) -> Column:
    """Named part of the day; everything outside the listed spans, and an unknown hour, is the late-night period."""
    spans = [F.when(hour.between(first, last), F.lit(label)) for first, last, label in S.PERIODS]
    return F.coalesce(*spans, F.lit(S.OTHER_PERIOD))


def distance_bucket(miles: Column) -> Column:
    """Half-open mileage buckets. A null distance lands in the last bucket, a negative one in the first."""
    below = [F.when(miles < bound, F.lit(label)) for bound, label in S.DISTANCE_BUCKETS]
    return F.coalesce(*below, F.lit(S.LONGEST_BUCKET))


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, in minutes; independent of the session time zone for zone-less input."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def tip_percent(tip: Column, fare: Column) -> Column:
    return F.when(fare > 0, rounded(tip / fare * 100)).otherwise(F.lit(0.0))


def revenue_without_tip(fare: Column, surcharges: list[Column]) -> Column:
    """Fare plus surcharges, added left to right; a missing surcharge counts as nothing."""
    return reduce(lambda total, part: total + F.coalesce(part.cast("double"), F.lit(0.0)), surcharges, fare)


def airport_flag(rate_code: Column, airport_fee: Column) -> Column:
    """Three-valued: unknown when neither input proves an airport trip and one of them is missing."""
    return rate_code.isin(*S.AIRPORT_RATE_CODES) | (airport_fee > 0)


def weekend_flag(day_of_week: Column) -> Column:
    return day_of_week.isin(*S.WEEKEND_DAYS)
