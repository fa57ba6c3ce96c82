"""Exact and approximate quantiles as one-row DataFrames, without a single-reducer sort or a per-group value map.

Exact path
----------
``percentile_disc`` keeps every distinct value of a column in one aggregation buffer, and a global sort moves every
row. Here the wanted order statistics are located by narrowing:

1. one narrow scan counts rows per coarse bucket (monotone, logarithmic, 0.2 % wide) -> the bucket of each rank;
2. a second one counts the distinct values of the chosen buckets only, a small share of the rows; every such count stays
   with its task until
3. twice over, counts per equal-width cell (of the cell chosen before) lead to the cell of the rank.

All counting combines on the map side, so a hot value costs one row per task. A bucket holds at most 2**43 different
doubles and each level divides by 2**22, so the last cell holds one value, however the values crowd. What reaches a single
task or a broadcast is bounded by the number of buckets, cells or targets, never by the number of rows or values. The scans
read only the columns asked for; give a stored table rather than an expensive plan.

Approximate path
----------------
``DataFrame.approxQuantile``: constant-size sketches merged in a tree. The rank error must be smaller than the tail
asked for, otherwise the sketch may answer with the plain minimum or maximum; such a call is refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOG_STEPS = 512  # buckets per e-fold of |value|
_LOG_OFFSET = 382_000  # above -512 * log(5e-324): every value but zero has a bucket above 0
_LOG_LIMIT = 365_000.0  # above 512 * log(1.8e308); holds the infinities
_CELLS = 1 << 22
_LEVELS = 2


@dataclass(frozen=True)
class Target:
    """One wanted order statistic: the value at rank ``ceil(probability * n)`` (+ number of negatives) of ``column``.

    ``skip_negatives`` moves the rank past the negative values; it serves quantiles of an imputed column.
    """

    name: str
    column: str
    probability: float
    skip_negatives: bool = False


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(measure, value)``: several numeric columns under each other; nulls and NaN are left out."""
    doubles = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "measure", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _coarse_bucket(value: Column) -> Column:
    steps = F.floor(F.least(F.ln(F.abs(value)) * F.lit(float(_LOG_STEPS)), F.lit(_LOG_LIMIT))) + _LOG_OFFSET
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * steps).cast("bigint")


def _fine_cell(value: Column, low: Column, high: Column) -> Column:
    share = (value - low) / (high - low)
    return F.when(high > low, F.floor(share * F.lit(float(_CELLS)))).otherwise(F.lit(0)).cast("bigint")


def _cell_of_rank(placed: DataFrame) -> DataFrame:
    """Per target the equal-width cell in which its rank falls: smallest and largest value, rank within the cell."""
    cells = placed.groupBy("target", "rank", _fine_cell(F.col("value"), F.col("low"), F.col("high")).alias("cell")).agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    upto = Window.partitionBy("target").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_upto") - F.col("n")
    return (
        cells.withColumn("_upto", F.sum("n").over(upto))
        .where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > before))
        .select("target", "low", "high", (F.col("rank") - before).alias("rank"))
    )


def _wanted(targets: list[Target]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(t.name).alias("target"),
                F.lit(t.column).alias("of"),
                F.lit(repr(t.probability)).cast("decimal(18,12)").alias("p"),
                F.lit(t.skip_negatives).alias("skip_negatives"),
            )
            for t in targets
        ]
    )


def coarse_counts(values: DataFrame) -> DataFrame:
    """Per measure and coarse bucket: rows, negatives, smallest and largest value, mean and variance. A few thousand rows
    per measure."""
    value = F.col("value")
    return values.groupBy("measure", _coarse_bucket(value).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(value < 0).alias("negatives"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("value").alias("mean"),
        F.var_pop("value").alias("variance"),
    )


def merged_counts(states: DataFrame) -> DataFrame:
    """Coarse counts of several batches, as those of all their values together: ``coarse_counts`` of each batch may be kept, and
    what is known of the whole follows without reading a value again."""
    whole = Window.partitionBy("measure", "bucket")
    n, mean = F.col("n"), F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    return (
        states.withColumn("_mean", mean)
        .groupBy("measure", "bucket")
        .agg(
            F.sum("n").alias("n"),
            F.sum("negatives").alias("negatives"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.first("_mean").alias("mean"),
            (F.sum(n * (F.col("variance") + F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0)))) / F.sum("n")).alias("variance"),
        )
    )


def order_statistics(values: DataFrame, targets: list[Target], coarse: DataFrame | None = None) -> DataFrame:
    """``(target, measure, value, whole)``: one row per target whose measure has any value. ``whole`` tells ``low``,
    ``high``, ``total`` (rows) and ``std`` of the measure, which the first scan finds anyway. ``coarse`` are the coarse
    counts of the same values, where they are known already: the values are then read once, in the buckets of the wanted ranks."""
    names = [t.name for t in targets]
    if len(set(names)) != len(names):
        raise ValueError(f"target names must be distinct: {names}")
    for t in targets:
        if not 0.0 <= t.probability <= 1.0:
            raise ValueError(f"probability out of [0, 1]: {t}")

    # step 1: the coarse bucket of every wanted rank
    whole = Window.partitionBy("measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.filter(_wanted(targets), lambda t: t["of"] == F.col("measure"))
    first_rank = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("p") * F.col("_total")).cast("bigint"))
    ranked = (
        (coarse_counts(values) if coarse is None else coarse)
        .withColumns(
            {
                "_upto": F.sum("n").over(upto),
                "_total": F.sum("n").over(whole),
                "_negatives": F.sum("negatives").over(whole),
                "_low": F.min("low").over(whole),
                "_high": F.max("high").over(whole),
                "_mean": F.sum(F.col("mean") * F.col("n")).over(whole) / F.sum("n").over(whole),
            }
        )
        .withColumn(
            "_squares",
            F.sum(F.col("n") * (F.col("variance") + F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0)))).over(whole),
        )
        .select("*", F.inline(wanted))
        .withColumn(
            "rank",
            F.least(
                F.col("_total"),
                first_rank + F.when(F.col("skip_negatives"), F.col("_negatives")).otherwise(F.lit(0)),
            ),
        )
    )
    before = F.col("_upto") - F.col("n")
    std = F.when(F.col("_total") > 1, F.sqrt(F.col("_squares") / (F.col("_total") - 1)))
    chosen = (
        ranked.where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > before))
        .select(
            "measure",
            "bucket",
            "low",
            "high",
            F.struct(
                F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_total").alias("total"), std.alias("std")
            ).alias("whole"),
            F.struct("target", (F.col("rank") - before).alias("rank")).alias("wanted"),
        )
        .groupBy("measure", "bucket", "low", "high", "whole")
        .agg(F.sort_array(F.collect_list("wanted")).alias("wanted"))
    )

    # step 2: value counts of the chosen buckets only. What is broadcast has one row per bucket with a target. Everything
    # else known about the bucket is a grouping key too, so that all uses below share one shuffle.
    keys = ["measure", "bucket", "low", "high", "whole", "wanted"]
    counts = (
        values.withColumn("bucket", _coarse_bucket(F.col("value")))
        .join(F.broadcast(chosen), ["measure", "bucket"])
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    # step 3: cell by cell to the value
    placed = counts.select("measure", "whole", "low", "high", "value", "n", F.inline("wanted"))
    for _ in range(_LEVELS):
        cell = _cell_of_rank(placed)
        placed = (
            placed.drop("low", "high", "rank")
            .join(F.broadcast(cell), "target")
            .where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        )
    # one value is left per target; reading its count keeps this use of the counts the same as the others, so it is shared
    left = placed.groupBy("target", "measure", "whole").agg(F.min("value").alias("value"), F.sum("n").alias("n"))
    return left.where(F.col("n") > 0).select("target", "measure", "value", "whole")


def exact_quantiles(df: DataFrame, targets: list[Target], coarse: DataFrame | None = None) -> DataFrame:
    """One row, one double column per target (null when its column holds no value)."""
    columns = sorted({t.column for t in targets})
    return one_row(order_statistics(long_values(df, columns), targets, coarse), targets)


def one_row(statistics: DataFrame, targets: list[Target]) -> DataFrame:
    return statistics.agg(
        *[F.max(F.when(F.col("target") == t.name, F.col("value"))).alias(t.name) for t in targets],
    )


def approximate_quantiles(df: DataFrame, targets: list[Target], relative_error: float = 0.0001) -> DataFrame:
    """Sketch version of :func:`exact_quantiles`; the rank error is at most ``relative_error * n``.

    Runs at once: one scan for all columns, partial sketches merged in a tree, a few numbers returned.
    """
    if any(t.skip_negatives for t in targets):
        raise ValueError("the sketch cannot skip negatives: impute the column first")
    for t in targets:
        require_resolvable(t.probability, relative_error)
    columns = sorted({t.column for t in targets})
    probabilities = sorted({t.probability for t in targets})
    doubles = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    found = {
        (column, p): value
        for column, values in zip(columns, doubles.approxQuantile(columns, probabilities, relative_error))
        for p, value in zip(probabilities, values)  # no values for a column without any
    }
    return df.sparkSession.range(1).select(
        *[F.lit(found.get((t.column, t.probability))).cast("double").alias(t.name) for t in targets]
    )


def require_resolvable(probability: float, relative_error: float) -> None:
    """Refuse an error as wide as the tail: the 1st percentile with error 0.01 may be the minimum."""
    if not 0.0 < relative_error < 1.0:
        raise ValueError(f"relative error must lie in (0, 1): {relative_error}")
    tail = min(probability, 1.0 - probability)
    if tail > 0.0 and relative_error >= tail:
        raise ValueError(f"relative error {relative_error} cannot resolve probability {probability}")
