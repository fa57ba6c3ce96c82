"""Connected components of a graph given as a table of links, by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

No step gathers the neighbours of a node: each takes a minimum per node, combined before the shuffle, and joins it back to
the links. Both sides of that join are written tables, so adaptive execution measures them and splits the links of a hub over
tasks. Every step is a written table: lineage does not grow, and a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.workspace import materialise


def _minima(links: DataFrame) -> tuple[DataFrame, int]:
    """For each x the smallest of x and its y; and how many x are neither root (all y larger) nor leaf (one y)."""
    seen = Observation()
    minima = links.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("least"), F.count(F.lit(1)).alias("n"))
    open_ends = F.count_if((F.col("least") < F.col("x")) & (F.col("n") > 1))
    written = materialise(minima.observe(seen, open_ends.alias("open")), "minima")
    return written.select("x", "least"), seen.get["open"]


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b of one orderable type, none null. Returns node and root: one row for every node that
    has a link to another, with the smallest node it can reach. An empty table gives an empty table."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
    links = materialise(links.distinct(), "links")
    while True:
        both = links.union(links.select(F.col("y"), F.col("x"))).toDF("x", "y")
        minima, open_ends = _minima(both)
        if not open_ends:  # every node hangs on its root
            return links.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
                links.select(F.col("y"), F.col("y")).distinct()
            )
        # larger neighbours of x move to the smallest node next to x
        large = both.join(minima, "x").where("y > x").select(F.col("y").alias("x"), F.col("least").alias("y"))
        large = materialise(large.distinct(), "large")
        # x and its smaller neighbours move to the smallest of these
        minima, _ = _minima(large)
        small = large.join(minima, "x")
        links = small.select("x", F.col("least").alias("y")).union(
            small.where("y <> least").select(F.col("y").alias("x"), F.col("least").alias("y"))
        )
        links = materialise(links.where("x <> y").distinct(), "links")
