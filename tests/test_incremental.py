"""Batches taken in one after the other give the warehouse of all of them at once."""

import datetime

import pytest

from tripmart import schemas as S
from tripmart.plans import incremental
from tripmart.plans.publish import Published
from tripmart.plans.warehouse import build_warehouse
from tripmart.sources.tables import scan_table
from tripmart.workspace import new_path

COLUMNS = [target for _, target in S.FACT_COLUMNS]


def trips(make, month, fares):
    start = datetime.datetime(2026, month, 3, 10)
    times = S.TIMESTAMP_COLUMNS
    return make(
        [
            {times[0]: start, times[1]: start + datetime.timedelta(minutes=9), "fare_amount": fare, "total_amount": 5.0, "trip_distance": 2.0,
             "VendorID": 1, "payment_type": month, "PULocationID": month, "DOLocationID": 1, "RatecodeID": 1.0, "passenger_count": 1.0}
            for fare in fares
        ]
    )


def bag(df):
    return sorted(map(str, df.select(*[c for c in df.columns if c != "trip_id"]).collect()))


def test_only_months_that_a_change_reaches_are_written(spark, make):
    zone, grown = new_path(spark, "zone"), Published(spark, new_path(spark, "grown"))
    calm = [5.0] * 500
    batches = [
        (trips(make, 1, calm), (1,), ()),
        (trips(make, 2, [*calm, -1.0]), (2,), (1,)),  # nothing moves
        (trips(make, 3, [9.0] * 1200), (2, 3), (1,)),  # the median moves: month 2 has a fare that it replaces
    ]
    whole = None
    for i, (batch, written, carried) in enumerate(batches):
        step = incremental.take_in(batch, zone, grown, 2026, i + 1)
        assert (step.written, step.carried) == (written, carried)
        whole = batch if whole is None else whole.unionAll(batch)
    base = new_path(spark, "whole")
    build_warehouse(whole, base)
    assert bag(incremental.fact(grown).select(*COLUMNS)) == bag(scan_table(spark, base, "fact_trips").select(*COLUMNS))
    for name in ("dim_time", "dim_location", "dim_payment", "dim_vendor"):
        assert bag(grown.read(name)) == bag(scan_table(spark, base, name)), name
    ids = [r.trip_id for r in incremental.fact(grown).collect()]
    assert len(set(ids)) == len(ids) == 2201
    assert incremental.fact(grown, 1).count() == 500  # earlier versions stay


@pytest.mark.parametrize("month", [4])
def test_an_empty_batch_changes_nothing(spark, make, month):
    zone, grown = new_path(spark, "zone"), Published(spark, new_path(spark, "grown"))
    incremental.take_in(trips(make, 1, [5.0, 6.0]), zone, grown, 2026, 1)
    step = incremental.take_in(trips(make, 2, []), zone, grown, 2026, month)
    assert step.written == () and step.carried == (1,) and incremental.fact(grown).count() == 2
