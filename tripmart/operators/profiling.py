"""Column profiles: a few narrow scans each, with aggregates that combine on the map side.

Definitions: sample standard deviation; discrete quantiles; equal-width histogram bins between minimum and maximum;
outliers beyond 1.5 interquartile ranges; Gaussian kernel density with Silverman's bandwidth
``0.9 * min(std, iqr / 1.34) * n ** -0.2``, evaluated on the histogram (centre of every bin).
"""

from __future__ import annotations

from functools import reduce

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.numeric import rounded, share_pct
from tripmart.operators.quantiles import Target, long_values, order_statistics

FENCE = 1.5


def missing_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and share per column, in one pass."""
    columns = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot(["_rows"], columns, "column_name", "missing").select(
        "column_name", "missing", rounded(share_pct(F.col("missing"), F.col("_rows"))).alias("missing_pct")
    )


def missing_matrix(df: DataFrame, block: Column, columns: list[str]) -> DataFrame:
    """Null share per row block and column; ``block`` says which rows form a block."""
    counted = df.groupBy(block.alias("block")).agg(
        F.count(F.lit(1)).alias("block_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot(["block", "block_rows"], columns, "column_name", "missing").withColumn(
        "missing_pct", rounded(share_pct(F.col("missing"), F.col("block_rows")))
    )


def _quantiles(values: DataFrame, columns: list[str], probabilities: dict[str, float]) -> DataFrame:
    """``measure``, ``whole`` and one column per probability. At most one row per profiled column."""
    targets = [Target(f"{c}/{name}", c, p) for c in columns for name, p in probabilities.items()]
    found = order_statistics(values, targets).withColumn("_which", F.substring_index("target", "/", -1))
    return found.groupBy("measure", "whole").agg(
        *[F.max(F.when(F.col("_which") == name, F.col("value"))).alias(name) for name in probabilities]
    )


def numeric_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, median, standard deviation, minimum and maximum per column."""
    clean = df.select(*[F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    moments = clean.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*columns)))
    medians = _quantiles(long_values(df, columns), columns, {"median": 0.5})
    return moments.join(F.broadcast(medians), F.col("column_name") == F.col("measure"), "left").select(
        "column_name", "n", *[rounded(F.col(c)).alias(c) for c in ("mean", "median", "std", "min", "max")]
    )


def _ranges(values: DataFrame) -> DataFrame:
    return values.groupBy("measure").agg(F.min("value").alias("low"), F.max("value").alias("high"))


def _binned(values: DataFrame, ranges: DataFrame, bins: int) -> DataFrame:
    """``measure, bin, n`` and the columns of ``ranges``, which has one row per profiled column with at least ``low`` and
    ``high``."""
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    number = F.when(
        F.col("high") > F.col("low"), F.least(F.floor(share * F.lit(float(bins))) + 1, F.lit(bins))
    ).otherwise(F.lit(1))
    return (
        values.join(F.broadcast(ranges), "measure")
        .groupBy("measure", number.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ranges.columns if c != "measure"])
    )


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins per column; empty bins are left out."""
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    values = long_values(df, columns)
    return _binned(values, _ranges(values), bins).select(
        F.col("measure").alias("column_name"),
        "bin",
        rounded(F.col("low") + width * (F.col("bin") - 1), 6).alias("low_edge"),
        rounded(F.col("low") + width * F.col("bin"), 6).alias("high_edge"),
        "n",
    )


def kernel_density(df: DataFrame, columns: list[str], bins: int = 64) -> DataFrame:
    """Density estimate at the centre of every bin; a constant column has none.

    The kernel sum runs over the at most ``bins`` histogram bins of its column, held in one array per column.
    """
    values = long_values(df, columns)
    spread = _quantiles(values, columns, {"q1": 0.25, "q3": 0.75}).select(
        "measure", "whole.*", (F.col("q3") - F.col("q1")).alias("iqr")
    )
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))

    def centre(number: Column) -> Column:
        return F.col("low") + width * (number - F.lit(0.5))

    per_column = (
        _binned(values, spread, bins)
        .groupBy("measure")
        .agg(
            F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"),
            *[F.first(c).alias(c) for c in spread.columns if c != "measure"],
        )
        .withColumn(
            "h",
            F.lit(0.9)
            * F.least(F.col("std"), F.nullif(F.col("iqr"), F.lit(0.0)) / F.lit(1.34))
            * F.pow(F.col("total").cast("double"), F.lit(-0.2)),
        )
        .where(F.col("h") > 0)
    )
    points = per_column.withColumn("point", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    x = centre(F.col("point"))
    kernel_sum = F.aggregate(
        "bins",
        F.lit(0.0),
        lambda acc, b: acc + b["n"] * F.exp(F.lit(-0.5) * F.pow((x - centre(b["bin"])) / F.col("h"), F.lit(2.0))),
    )
    density = kernel_sum / (F.col("total") * F.col("h") * F.lit(math.sqrt(2.0 * math.pi)))
    return points.select(
        F.col("measure").alias("column_name"), "point", rounded(x, 6).alias("x"), rounded(density, 6).alias("density")
    )


def outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values outside the interquartile fences, per column."""
    values = long_values(df, columns)
    fences = _quantiles(values, columns, {"q1": 0.25, "q3": 0.75}).select(
        "measure",
        "q1",
        "q3",
        (F.col("q1") - F.lit(FENCE) * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
        (F.col("q3") + F.lit(FENCE) * (F.col("q3") - F.col("q1"))).alias("upper_fence"),
    )
    value = F.col("value")
    counted = (
        values.join(F.broadcast(fences), "measure")
        .groupBy("measure")
        .agg(
            *[F.first(c).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")],
            F.count_if(value < F.col("lower_fence")).alias("below"),
            F.count_if(value > F.col("upper_fence")).alias("above"),
            F.count(F.lit(1)).alias("total"),
        )
    )
    return counted.select(
        F.col("measure").alias("column_name"),
        *[rounded(F.col(c), 6).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")],
        "below",
        "above",
        rounded(share_pct(F.col("below") + F.col("above"), F.col("total"))).alias("outlier_pct"),
    )


def _row_hash(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, nulls told apart from absent values by their place."""
    cells = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns]
    return F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells[::-1])


def _duplicate_groups(df: DataFrame, columns: list[str], hashes: tuple[Column, Column]) -> tuple[DataFrame, DataFrame]:
    """(hash groups with their size, groups of equal rows within hash groups above one). Rows are grouped by hashes alone;
    only rows whose hashes occur again are compared whole."""
    a, b = hashes
    hashed = df.select(*[F.col(f"`{c}`") for c in columns]).withColumns({"_a": a, "_b": b})
    by_hash = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_rows"))
    again = by_hash.where(F.col("_rows") > 1).select("_a", "_b")
    equal = hashed.join(again, ["_a", "_b"]).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return by_hash, equal


def duplicate_rows(df: DataFrame, columns: list[str] | None = None, hashes: tuple[Column, Column] | None = None) -> DataFrame:
    """Groups of rows equal in ``columns`` (default: all), with their size. ``hashes`` replaces the row hash; any pair of
    expressions that equal rows share gives the same result."""
    columns = columns or df.columns
    _, equal = _duplicate_groups(df, columns, hashes or _row_hash(columns))
    return equal.where(F.col("copies") > 1)


def duplicate_summary(df: DataFrame, columns: list[str] | None = None, hashes: tuple[Column, Column] | None = None) -> DataFrame:
    """One row: rows, distinct rows, duplicated groups, and rows beyond the first of each group."""
    columns = columns or df.columns
    by_hash, equal = _duplicate_groups(df, columns, hashes or _row_hash(columns))
    copies, nothing = F.col("copies"), F.lit(0).cast("bigint")
    alone = by_hash.agg(
        F.coalesce(F.sum("_rows"), nothing).alias("total_rows"), F.count_if(F.col("_rows") == 1).alias("alone")
    )
    groups = equal.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(copies > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(copies - 1), nothing).alias("surplus_rows"),
    )
    found = groups.select(F.struct(*groups.columns)).scalar()
    return alone.select(
        "total_rows",
        (F.col("alone") + found["groups"]).alias("distinct_rows"),
        found["duplicate_groups"].alias("duplicate_groups"),
        found["surplus_rows"].alias("surplus_rows"),
    )


def profile_sample(df: DataFrame, rows: int = 200_000, seed: int = 42) -> DataFrame:
    """``rows`` random rows: a Bernoulli sample over the target size by ten standard deviations and 100 rows, cut to it by
    the lowest draws. A table that is not larger than the target comes back whole."""
    size = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    fraction = F.lit(rows + 10 * math.sqrt(rows) + 100) / F.nullif(size, F.lit(0)).cast("double")
    drawn = df.withColumn("_draw", F.rand(seed)).where(F.col("_draw") < F.coalesce(fraction, F.lit(1.0)))
    return drawn.orderBy("_draw").limit(rows).drop("_draw")


#: Steps of the scale on which a sample finds its threshold.
_STEPS = 1 << 16


def bottom_sample(df: DataFrame, rows: int, key: Column | None = None) -> DataFrame:
    """The ``rows`` rows with the smallest hash (of the whole row, or a ``key`` of hexadecimal digits): the same rows however the table
    is partitioned, and samples of parts merge into the sample of the whole by taking the smallest again. Fewer if there are
    fewer. Of equal keys any rows count.

    Hashes are counted on a scale of 65,536 steps first. Rows below the step that the sample ends in are taken where they are; only
    those of that step are sorted.
    """
    every = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    digits = F.lower(F.lpad(F.hex(F.xxhash64(*every)), 16, "0")) if key is None else key
    names = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    hashed = df.select(*names, digits.alias("hash")).withColumn("step", F.conv(F.substring("hash", 1, 4), 16, 10).cast("int"))
    steps = sorted(hashed.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect())  # 65,536 numbers at most
    taken, last = 0, _STEPS
    for row in steps:
        if taken + row.n > rows:
            last = row.step
            break
        taken += row.n
    below = hashed.where(F.col("step") < last)
    rest = hashed.where(F.col("step") == last).orderBy("hash").limit(rows - taken)
    return below.unionByName(rest).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def missing_together(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_a, column_b, both_missing, share``: for every pair of columns (and each with itself) how many rows lack both. Rows are
    counted by the set of columns they lack, as bits; pairs are read off these sets, of which there are few, so the table is
    scanned once and nothing grows with the square of the columns times the rows."""
    columns = df.columns if columns is None else columns
    if len(columns) > 63:
        raise ValueError("at most 63 columns at a time")
    bits = reduce(
        lambda mask, item: mask.bitwiseOR(F.when(F.col(f"`{item[1]}`").isNull(), F.lit(1 << item[0])).otherwise(F.lit(0)).cast("bigint")),
        enumerate(columns),
        F.lit(0).cast("bigint"),
    )
    masks = df.select(bits.alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    pairs = df.sparkSession.createDataFrame(
        [(a, b, (1 << i) | (1 << j)) for i, a in enumerate(columns) for j, b in enumerate(columns)], "column_a string, column_b string, both bigint"
    )
    total = F.coalesce(masks.agg(F.sum("n")).scalar(), F.lit(0).cast("bigint"))
    both = F.array(*[F.lit((1 << i) | (1 << j)).cast("bigint") for i in range(len(columns)) for j in range(i + 1)])
    held = F.filter(both, lambda b: F.col("mask").bitwiseAND(b) == b)
    hits = masks.select("n", F.explode(held).alias("both")).groupBy("both").agg(F.sum("n").alias("hits"))
    missing = F.coalesce("hits", F.lit(0).cast("bigint"))
    return pairs.join(hits, "both", "left").select(
        "column_a", "column_b", missing.alias("both_missing"), rounded(missing / F.nullif(total, F.lit(0).cast("bigint")) * 100).alias("share")
    )
