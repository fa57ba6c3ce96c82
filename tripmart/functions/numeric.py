"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, places: int = 2) -> Column:
    """Round half-up through DECIMAL(38,8), so that another engine rounds the same number to the same result.

    30 integer digits leave room for sums over very large tables. A number beyond is its own rounding: a double of that size
    has no fraction. Infinities and NaN stay, too.
    """
    exact = F.round(value.try_cast("decimal(38,8)"), places).try_cast("double")
    return F.coalesce(exact, value.try_cast("double"))


def pct_change(value: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent; null when there is no previous value or it is zero."""
    return (value - previous) / F.nullif(previous, F.lit(0.0)) * F.lit(100.0)


def share_pct(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * F.lit(100.0)
