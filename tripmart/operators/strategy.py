"""A proposed cleaning strategy: for each finding of the profile the action, the value it puts in, why, and what it leaves.

The proposal is checked by what it would do: findings are counted on the raw trips and again on the cleaned ones, so an action
that does not settle its finding shows up as rows left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.numeric import rounded, share_pct
from tripmart.operators.cleaning import add_duration, as_scalar, clean_trips, standardise
from tripmart.operators.quality import count_findings, finding_rules

#: A finding that more than this share of the rows has, in percent, is more than the routine action should settle.
WIDESPREAD = 20.0

#: finding: column, action, the statistic or number that it puts in, reason
ACTIONS: dict[str, tuple[str, str, str | float | None, str]] = {
    "negative_fare": ("fare_amount", "impute", "fare_median", "a refund or a typing error; the median is not moved by extremes"),
    "null_fare": ("fare_amount", "cap", "fare_low", "an unknown fare is raised to the lower bound with the extremes"),
    "extreme_fare": ("fare_amount", "cap", None, "beyond the 1st and 99th percentile, which would rule the averages"),
    "negative_tip": ("tip_amount", "replace", 0.0, "a tip cannot be negative; none was given"),
    "nonpositive_total": ("total_amount", "flag", None, "the trip took place; reports on revenue leave it out"),
    "null_total": ("total_amount", "keep", None, "the flag stays unknown; reports on revenue leave it out"),
    "missing_passengers": ("passenger_count", "replace", float(S.DEFAULT_PASSENGERS), "most trips have one passenger"),
    "negative_passengers": ("passenger_count", "keep", None, "not seen in the data; counted so that it would be noticed"),
    "too_many_passengers": ("passenger_count", "cap", float(S.MAX_PASSENGERS), "more than a cab may legally carry"),
    "zero_distance": ("trip_distance", "impute", "distance_median", "the meter failed; the trip took time and money"),
    "negative_distance": ("trip_distance", "keep", None, "falls into the shortest bucket; counted so that it would be noticed"),
    "null_distance": ("trip_distance", "keep", None, "has no bucket of its own worth inventing"),
    "nonpositive_duration": ("trip_duration_min", "drop", None, "ends before it begins, so neither time can be trusted"),
    "unknown_duration": ("trip_duration_min", "drop", None, "has no place in a calendar"),
}


def cleaning_strategy(raw: DataFrame, statistics: DataFrame) -> DataFrame:
    """A row per finding: ``finding, column_name, row_count, pct, action, replacement, reason, rows_left``.

    A finding that no row has needs no action (``none``); one that more than WIDESPREAD percent have is to be looked into at its
    source (``investigate``), whatever the routine. ``rows_left`` counts the finding among the rows that cleaning keeps. No rows at all
    give a null share and no actions. ``statistics`` is one row, as ``trip_statistics`` makes it.
    """
    known = as_scalar(statistics)
    fare = F.col("fare_amount")
    rules = finding_rules() | {"extreme_fare": (fare >= 0) & ((fare < known["fare_low"]) | (fare > known["fare_high"]))}
    before = count_findings(add_duration(standardise(raw)), rules)
    after = count_findings(clean_trips(raw, statistics), rules).select("finding", F.col("row_count").alias("rows_left"))
    routine = before.sparkSession.createDataFrame(
        [(name, column, action, value if isinstance(value, float) else None, value if isinstance(value, str) else None, why)
         for name, (column, action, value, why) in ACTIONS.items()],
        "finding string, column_name string, routine string, fixed double, statistic string, reason string",
    )
    used = ("fare_median", "fare_low", "distance_median")
    value = F.coalesce("fixed", *[F.when(F.col("statistic") == n, known[n]) for n in used])
    pct, seen = share_pct(F.col("row_count"), F.col("all_rows")), F.col("row_count") > 0
    action = F.when(~seen, F.lit("none")).when(pct > WIDESPREAD, F.lit("investigate")).otherwise(F.col("routine"))
    return (
        before.join(after, "finding")
        .join(routine, "finding")
        .select(
            "finding",
            "column_name",
            "row_count",
            rounded(pct).alias("pct"),
            action.alias("action"),
            rounded(F.when(seen, value), 6).alias("replacement"),
            "reason",
            "rows_left",
        )
    )
