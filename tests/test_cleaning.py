from datetime import datetime

import pytest

from tripmart.operators import cleaning as C
from tripmart.operators import derivation as D
from tripmart.operators.quality import dq_findings, row_lineage

T0 = datetime(2023, 1, 1, 10, 30)
T1 = datetime(2023, 1, 1, 10, 45)
OK = {"tpep_pickup_datetime": T0, "tpep_dropoff_datetime": T1}


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def test_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "abc"), (None, "99999999999999")], "passenger_count string, tip_amount string")
    out = C.conform_types(df)
    assert dict(out.dtypes) == {"passenger_count": "int", "tip_amount": "double"}
    assert column(out, "passenger_count") == [1, None, None]
    assert column(out, "tip_amount") == [2.5, None, 99999999999999.0]


def test_conforming_frame_is_left_alone(spark):
    df = spark.createDataFrame([(1, 2.0)], "passenger_count int, tip_amount double")
    assert C.conform_types(df) is df


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, make, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        native = D.add_calendar(C.standardise(make([OK])))
        assert column(native, "pickup_hour") == [10]
        text = spark.createDataFrame(
            [("2023-01-01 10:30:00", "2023-03-12 02:30:00"), ("2023-13-01 10:30:00", "01/02/2023")],
            "tpep_pickup_datetime string, tpep_dropoff_datetime string",
        )
        parsed = C.parse_timestamps(text)
        assert [c for _, c in parsed.dtypes] == ["timestamp_ntz"] * 2
        # 02:30 on that day does not exist in New York; a zone-less time keeps it
        assert column(parsed, "tpep_dropoff_datetime") == [datetime(2023, 3, 12, 2, 30), None]
        assert column(parsed, "tpep_pickup_datetime") == [T0, None]
        minutes = C.add_duration(make([OK]))
        assert column(minutes, "trip_duration_min") == [15.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_money_rules(make):
    df = make([{"fare_amount": f, "tip_amount": t, "total_amount": x} for f, t, x in
               [(-4.0, -1.0, 0.0), (2.0, 0.5, -3.0), (3.0, None, 9.0), (None, 0.0, None), (8.0, 1.0, 1.0)]])
    stats = C.trip_statistics(df)
    assert column(C.impute_negative_fare(df, stats), "fare_amount") == [2.0, 2.0, 3.0, None, 8.0]
    assert column(C.floor_negative_tip(df), "tip_amount") == [0.0, 0.5, None, 0.0, 1.0]
    assert column(C.flag_invalid_total(df), "is_invalid_total") == [True, True, False, None, False]


def test_null_fare_becomes_the_lower_bound(make):
    df = make([{"fare_amount": f} for f in (None, 1.0, 2.0, 300.0)])
    assert column(C.winsorise_fare(df, C.trip_statistics(df)), "fare_amount") == [1.0, 1.0, 2.0, 300.0]


def test_passengers(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (6,), (7,), (-2,)], "passenger_count int")
    assert column(C.fix_passengers(df), "passenger_count") == [1, 1, 1, 6, 6, -2]


def test_zero_distance_gets_the_median_with_zeros_in_it(make):
    df = make([{"trip_distance": d} for d in (0.0, 0.0, 4.0, 5.0, 6.0, None, -1.0)])
    assert column(C.impute_zero_distance(df, C.trip_statistics(df)), "trip_distance") == [0.0, 0.0, 4.0, 5.0, 6.0, None, -1.0]
    df = make([{"trip_distance": d} for d in (0.0, 4.0, 5.0)])
    assert column(C.impute_zero_distance(df, C.trip_statistics(df)), "trip_distance") == [4.0, 4.0, 5.0]


def test_unknown_durations_are_dropped_but_counted_apart(make):
    df = make([OK, {**OK, "tpep_dropoff_datetime": T0}, {**OK, "tpep_pickup_datetime": None}, {}])
    assert C.kept_trips(df).count() == 1
    row = row_lineage(df).collect()[0].asDict()
    assert row == {"raw_rows": 4, "kept_rows": 1, "dropped_invalid": 1, "dropped_unknown": 2, "dropped_rows": 3, "dropped_pct": 75.0}


def test_empty_input_passes_through(make):
    empty = make([])
    assert C.clean_trips(empty).count() == 0
    row = row_lineage(empty).collect()[0]
    assert (row["raw_rows"], row["dropped_pct"]) == (0, None)
    assert {r["pct"] for r in dq_findings(empty).collect()} == {None}


def test_all_null_columns(make):
    assert C.clean_trips(make([OK, OK])).select("fare_amount", "trip_distance").distinct().collect() == [(None, None)]


def test_findings_count_what_the_rules_touch(make):
    df = make([{"passenger_count": -1.0, "trip_distance": -2.0, **OK}, {"passenger_count": 9.0, "trip_distance": 0.0, "fare_amount": -1.0}])
    found = {r["finding"]: r["row_count"] for r in dq_findings(df).collect()}
    assert found["negative_passengers"] == found["negative_distance"] == found["too_many_passengers"] == 1
    assert found["zero_distance"] == found["negative_fare"] == found["unknown_duration"] == 1
    assert found["null_fare"] == 1 and found["null_total"] == 2
