"""Stretches of a curve: filters on any coordinate skip files and row groups."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripmart.sources import sinks
from tripmart.workspace import new_path


def test_the_curve_interleaves_bits(spark):
    rows = spark.createDataFrame([(0b101, 0b011), (None, 3), (-4, 1), (65535, 65535)], "x int, y long")
    found = [r[0] for r in rows.select(sinks.curve(F.col("x"), F.col("y"))).collect()]
    assert found == [0b011011, 0b1010, 0b10, (1 << 32) - 1]


def test_filters_skip_row_groups(spark):
    path = new_path(spark, "clustered")
    trips = spark.range(60_000).selectExpr("CAST(pmod(xxhash64(id), 2) AS INT) AS m", "CAST(pmod(xxhash64(id, 1), 32) AS INT) AS day", "pmod(xxhash64(id, 2), 256) AS zone")
    assert sinks.write_clustered(trips, path, "m", sinks.curve(F.col("day") * 8, F.col("zone")), files=64) == 60_000
    groups = [
        {name: (s.min, s.max) for name, s in ((g.column(c).path_in_schema, g.column(c).statistics) for c in range(g.num_columns))}
        for file in glob.glob(f"{path.removeprefix('file:')}/m=*/*.parquet")
        for meta in [pq.ParquetFile(file).metadata]
        for g in (meta.row_group(i) for i in range(meta.num_row_groups))
    ]
    assert len(groups) >= 64
    by_zone = sum(g["zone"][0] <= 9 and g["zone"][1] >= 5 for g in groups)
    by_day = sum(g["day"][0] <= 4 and g["day"][1] >= 3 for g in groups)
    both = sum(g["zone"][0] <= 9 and g["zone"][1] >= 5 and g["day"][0] <= 4 and g["day"][1] >= 3 for g in groups)
    # ranges are cut by a sample, and a filter may lie across a cell: a good part must go, not an exact one
    assert by_zone < len(groups) / 2 and by_day < len(groups) / 2 and both <= len(groups) / 6
    read = spark.read.parquet(path).where("m = 1 AND zone BETWEEN 5 AND 9")
    assert read.count() == trips.where("m = 1 AND zone BETWEEN 5 AND 9").count()
    plan = plan_of(read)
    assert "PartitionFilters: [isnotnull(m" in plan and "GreaterThanOrEqual(zone,5)" in plan
