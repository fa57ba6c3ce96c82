"""Numbers and ranks over ranges against the same by one sort in Python."""

import random

import pytest

from tests.conftest import plan_of
from tripmart.operators.ordering import ascending, descending, numbered, ranked

DDL = "k int, v double, s string, place string"


def rows(seed, n, keys):
    draw = random.Random(seed)
    return [
        (draw.choice([None, *range(keys)]), draw.choice([None, 0.5, 1.5]), draw.choice(["a", "b", None]), f"p{i % 3}")
        for i in range(n)
    ]


def first(value):
    return (value is not None, value if value is not None else 0)


def order(row):
    return tuple((x is not None, x if x is not None else (0 if i < 2 else "")) for i, x in enumerate(row))


@pytest.mark.parametrize("keys", [1, 5, 400])
def test_numbers_do_not_depend_on_partitions(spark, keys):
    data = rows(keys, 700, keys)
    by = [ascending(c) for c in ("k", "v", "s", "place")]
    found = []
    for parts, ranges in ((1, 3), (7, 1), (4, 16)):
        df = spark.createDataFrame(data, DDL).repartition(parts)
        found.append(sorted((r.id, r.k, r.v, r.s, r.place) for r in numbered(df, by, "id", ranges).collect()))
    expected = [(i + 1, *row) for i, row in enumerate(sorted(data, key=order))]
    assert found[0] == found[1] == found[2] == expected


def rank_of(data, position, reverse):
    values = [r[position] for r in data]
    known = sorted((v for v in values if v is not None), reverse=reverse)
    return {v: (known.index(v) if v is not None else (len(known) if reverse else 0)) + 1 + (0 if reverse or v is None else values.count(None)) for v in set(values)}


@pytest.mark.parametrize("keys", [1, 2, 50])
@pytest.mark.parametrize("ranges", [1, 5, 30])
def test_ranks_carry_ties_over_ranges(spark, keys, ranges):
    """With few keys every key spreads over many ranges, and some ranges hold one key only."""
    data = rows(9, 500, keys)
    df = spark.createDataFrame(data, DDL).repartition(6)
    down = rank_of(data, 0, True)
    assert all(r["rank"] == down[r.k] for r in ranked(df, [descending("k")], ranges=ranges).collect())
    up = rank_of(data, 0, False)
    assert all(r["rank"] == up[r.k] for r in ranked(df, [ascending("k")], ranges=ranges).collect())


def test_a_hot_key_is_spread_over_ranges(spark):
    df = spark.range(4000).selectExpr("0 AS k", "id")
    out = ranked(df, [ascending("k")], "r", 8)
    assert {r.r for r in out.collect()} == {1} and out.count() == 4000
    parts = numbered(df, [ascending("k")], "n", 8)
    assert sorted(r.n for r in parts.collect()) == list(range(1, 4001))
    assert len(parts.inputFiles()) == 8  # all ranges have rows


def test_no_window_over_the_whole_table(spark):
    df = spark.createDataFrame(rows(1, 50, 5), DDL)
    for out in (numbered(df, [ascending("k")]), ranked(df, [ascending("k")])):
        assert "Window" not in plan_of(out) and "SinglePartition" not in plan_of(out)


def test_empty_tables_and_clashing_names(spark):
    nothing = spark.createDataFrame([], "o0 int, tie_a int, row int, place int, `range` int, key_a int")
    assert numbered(nothing, [ascending("o0")]).count() == ranked(nothing, [ascending("o0")]).count() == 0
    one = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], nothing.schema)
    assert [tuple(r) for r in ranked(one, [descending("row")]).collect()] == [(1, 1, 2, 3, 4, 5, 6)]
    assert [tuple(r) for r in numbered(one, [descending("row")]).collect()] == [(1, 1, 2, 3, 4, 5, 6)]
