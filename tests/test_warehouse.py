from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripmart.catalog import stage
from tripmart.operators import joins, modelling
from tripmart.operators.quality import overall, row_lineage
from tripmart.plans import charts, reports
from tripmart.plans.warehouse import build_warehouse, prepared_trips, run_warehouse_job, validate_warehouse
from tripmart.sources.sinks import write_table
from tripmart.sources.tables import register_views, scan_table, scan_warehouse
from tripmart.workspace import new_path


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return stage.warehouse(spark, sf_dir)


@pytest.fixture(scope="module")
def tables(spark, built):
    return scan_warehouse(spark, built.base)


# ------------------------------------------------------------------ invariants
def test_every_raw_row_is_kept_or_counted_as_dropped(spark, sf_dir, built, tables):
    row = row_lineage(stage.raw_trips(spark, sf_dir)).first()
    assert built.counts["fact_trips"] == row["kept_rows"] == tables["fact_trips"].count()
    assert row["kept_rows"] + row["dropped_rows"] == row["raw_rows"]


def test_dimensions_cover_the_fact_and_do_not_multiply_it(tables):
    fact = tables["fact_trips"]
    n = fact.count()
    assert joins.with_time(fact, tables["dim_time"], ["week_of_year"]).count() == n
    assert joins.with_location_roles(fact, tables["dim_location"]).count() == n
    assert fact.join(joins.payment_labels(tables["dim_payment"]), "payment_key").count() == n
    assert joins.with_vendor(fact, tables["dim_vendor"]).count() == n
    # the keys the documentation names would multiply rows
    assert fact.join(tables["dim_payment"], "payment_key").count() > n
    assert fact.join(tables["dim_time"], "date_key").count() > n


def test_surrogate_ids_are_unique(tables):
    row = tables["fact_trips"].agg(F.count("trip_id"), F.count_distinct("trip_id")).first()
    assert row[0] == row[1]


def test_report_text_runs_on_registered_views_except_for_the_missing_label(spark, tables):
    register_views(tables)
    assert spark.sql("SELECT COUNT(*) FROM fact_trips WHERE is_invalid_total = false").first()[0] > 0
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        spark.sql("SELECT payment_label FROM fact_trips")


def test_validation_goes_on_after_an_unreadable_table(spark, sf_dir, make):
    base = new_path(spark, "broken")
    counts = build_warehouse(make([{"tpep_pickup_datetime": datetime(2023, 1, 1), "tpep_dropoff_datetime": datetime(2023, 1, 2)}]), base)
    assert counts == {"fact_trips": 1, "dim_time": 1, "dim_location": 1 + 1, "dim_payment": 1, "dim_vendor": 2}
    verdict = validate_warehouse(spark, base, {**counts, "dim_time": 7})
    rows = {(r["table_name"], r["check_name"], r["column_name"]): r for r in verdict.collect()}
    assert rows["fact_trips", "row_count", None]["passed"]
    assert not rows["dim_time", "row_count", None]["passed"]
    assert rows["dim_payment", "not_null", "payment_key"]["observed"] == 1
    row = overall(verdict).first()
    assert (row["errors"], row["all_passed"]) == (1, False)
    # null assertions only warn unless told otherwise
    assert overall(validate_warehouse(spark, base, counts)).first()["all_passed"]
    assert not overall(validate_warehouse(spark, base, counts, "error")).first()["all_passed"]
    missing = validate_warehouse(spark, base + "-nowhere", counts).collect()
    assert [r["check_name"] for r in missing] == ["readable"] * 5 and not any(r["passed"] for r in missing)
    assert all("PATH_NOT_FOUND" in r["error"] for r in missing)


@pytest.mark.parametrize("content", [b"no parquet at all", b"PAR1" + b"\0" * 40])
def test_validation_goes_on_after_a_damaged_table(spark, tmp_path, make, content):
    counts = build_warehouse(make([{"tpep_pickup_datetime": datetime(2023, 1, 1), "tpep_dropoff_datetime": datetime(2023, 1, 2)}]), str(tmp_path))
    for file in (tmp_path / "dim_time").glob("*.parquet"):
        whole = file.read_bytes()
        file.write_bytes(content if content[:2] == b"no" else whole[: len(whole) // 2])
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    rows = validate_warehouse(spark, str(tmp_path), counts).collect()
    by_table = {t: [r for r in rows if r["table_name"] == t] for t in counts}
    assert [(r["check_name"], r["passed"]) for r in by_table["dim_time"]] == [("readable", False)]
    assert by_table["dim_time"][0]["error"]
    assert all(r["passed"] for t, found in by_table.items() if t != "dim_time" for r in found if r["check_name"] == "row_count")


def test_an_empty_fact_by_year_has_its_year(spark, make, tmp_path):
    build_warehouse(make([]), str(tmp_path), by_year=True)
    assert "pickup_year" in scan_table(spark, str(tmp_path), "fact_trips", by_year=True).columns


def test_fact_is_written_where_it_is_read(spark, sf_dir):
    fact = modelling.fact_columns(prepared_trips(stage.raw_trips(spark, sf_dir)))
    main = [line for line in plan_of(fact).splitlines() if not line.lstrip().startswith(":")]  # without the statistics
    assert "FileScan" in str(main) and "Exchange" not in str(main)


def test_job_on_empty_input(spark, make):
    row = run_warehouse_job(make([]), new_path(spark, "empty")).first()
    assert (row["raw_rows"], row["fact_rows"], row["dropped_pct"], row["rows_traced"]) == (0, 0, None, True)


def test_year_can_lead_the_partitions(spark, make):
    base = new_path(spark, "years")
    start = datetime(2001, 5, 1)
    rows = [{"tpep_pickup_datetime": d, "tpep_dropoff_datetime": d + timedelta(minutes=5)} for d in (start, datetime(2023, 5, 1))]
    build_warehouse(make(rows), base, by_year=True)
    fact = scan_table(spark, base, "fact_trips")
    assert sorted(r[0] for r in fact.select("pickup_year").collect()) == [2001, 2023]


# ------------------------------------------------------------------ plans
def test_month_filter_prunes_partitions_and_columns(tables):
    plan = plan_of(tables["fact_trips"].where("pickup_month = 3").select("fare_amount"))
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert "ReadSchema: struct<fare_amount:double>" in plan


def test_vendor_join_is_broadcast(tables, spark):
    plan = plan_of(joins.with_vendor(tables["fact_trips"], modelling.dim_vendor(spark)))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan and "SortMergeJoin" not in plan


def test_report_joins_see_aggregated_trips(tables):
    for df in (
        reports.tip_by_distance(tables["fact_trips"], tables["dim_payment"]),
        reports.airport_iso_weeks(tables["fact_trips"], tables["dim_time"]),
        reports.vendor_revenue(tables["fact_trips"], tables["dim_vendor"]),
    ):
        plan = plan_of(df)
        join, scan = plan.index("Join"), plan.index("FileScan")
        assert "HashAggregate" in plan[join:scan]


def test_zone_ranking_keeps_only_candidates_before_the_window(tables):
    plan = plan_of(reports.top_zones(tables["fact_trips"]))
    assert "WindowGroupLimit" in plan and "count(distinct" not in plan


def test_trend_sorts_once(tables):
    plan = plan_of(reports.airport_trend(tables["fact_trips"]))
    assert plan.count("+- Window [") == 1


def test_fact_write_splits_a_hot_month(spark, sf_dir):
    """Nine of ten rows in one month: with small advisory sizes that month must be written by several tasks."""
    trips = stage.table(spark, sf_dir, "fact_trips").drop("trip_id")
    hot = trips.withColumn("pickup_month", F.when(F.rand(1) < 0.9, 1).otherwise(F.col("pickup_month")))
    hot = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("copy"))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = new_path(spark, "hot")
        n = write_table(hot, path, ["pickup_month"], rebalance=True, last_step=modelling.add_surrogate_key)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(path)
    assert back.count() == n == hot.count()
    assert back.select("trip_id").distinct().count() == n
    per_month = {r[0]: r[1] for r in back.groupBy("pickup_month").agg(F.count_distinct(F.col("_metadata.file_path"))).collect()}
    assert per_month[1] > 1


# ------------------------------------------------------------------ report semantics
def _fact(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def test_unknown_validity_is_left_out_of_revenue(spark):
    fact = _fact(spark, [("Midday", 5.0, False), ("Midday", 7.0, None), ("Night", -1.0, True)],
                 "time_of_day string, total_amount double, is_invalid_total boolean").withColumns(
        {c: F.lit(1.0) for c in ("fare_amount", "tip_pct", "trip_duration_min")})
    rows = reports.revenue_by_period(fact).collect()
    assert [(r["time_of_day"], r["trip_count"], r["total_revenue"]) for r in rows] == [("Midday", 1, 5.0)]


def test_tied_zones_share_a_rank_and_may_exceed_the_limit(spark):
    fact = _fact(spark, [(z, 10.0, False) for z in (1, 2, 3)] + [(4, 1.0, False)],
                 "pickup_location_id long, total_amount double, is_invalid_total boolean").withColumn("date_key", F.lit("2023-01-01").cast("date"))
    rows = reports.top_zones(fact, 2).collect()
    assert [(r["pickup_location_id"], r["revenue_rank"]) for r in rows] == [(1, 1), (2, 1), (3, 1)]


def test_tied_tips_are_numbered_by_bucket(spark):
    fact = _fact(spark, [("3–5 mi", 1, 10.0, 1.0), ("1–3 mi", 1, 10.0, 1.0), ("1–3 mi", 9, 10.0, 1.0)],
                 "distance_bucket string, payment_key long, tip_pct double, fare_amount double")
    pay = _fact(spark, [(1, "Credit Card"), (1, "Credit Card"), (9, "Unknown")], "payment_key long, payment_label string")
    rows = reports.tip_by_distance(fact, pay).collect()
    assert [(r["distance_bucket"], r["top_tipping_rank_within_payment"], r["trip_count"]) for r in rows] == [("1–3 mi", 1, 1), ("3–5 mi", 2, 1)]
    assert [r["distance_bucket"] for r in reports.top_tipping_band(fact, pay).collect()] == ["1–3 mi"]


def test_previous_period_of_each_trip_kind(spark):
    rows = [(1, 1, k, 100.0 * m) for m, k in ((1, True), (3, False), (7, None))] + [(2, 3, True, 150.0), (2, 3, None, 0.0)]
    fact = _fact(spark, rows, "pickup_month int, pickup_dow int, is_airport_trip boolean, total_amount double").withColumns(
        {"is_invalid_total": F.lit(False), "fare_amount": F.lit(1.0), "trip_distance": F.lit(1.0), "tip_pct": F.lit(1.0)})
    got = [(r["is_airport_trip"], r["prev_period_revenue"], r["revenue_pct_change"]) for r in reports.airport_trend(fact).collect()]
    assert got == [(True, None, None), (True, 100.0, 50.0), (False, None, None), (None, None, None), (None, 700.0, -100.0)]
    means = charts.airport_means(reports.airport_trend(fact)).collect()
    assert [r["trip_kind"] for r in means] == ["Airport Trip", "City Trip"]


def test_unknown_vendors_share_a_null_name(spark):
    fact = _fact(spark, [(1, 1.0), (6, 2.0), (None, 4.0)], "vendor_id long, total_amount double")
    rows = reports.vendor_revenue(fact, modelling.dim_vendor(spark)).collect()
    assert [(r[0], r[1]) for r in rows] == [(None, 6.0), ("Creative Mobile Technologies", 1.0)]
    assert joins.with_vendor(fact, modelling.dim_vendor(spark)).columns.count("vendor_id") == 1


def test_payment_shares_add_up(tables):
    tips = reports.tip_by_distance(tables["fact_trips"], tables["dim_payment"])
    assert abs(sum(r["share_pct"] for r in charts.payment_share(tips).collect()) - 100.0) < 0.02


def test_cleaned_trips_are_one_pass_of_projections(spark, sf_dir):
    plan = plan_of(prepared_trips(stage.raw_trips(spark, sf_dir)).select("pickup_hour", "payment_label"))
    assert "Exchange" not in plan and "Python" not in plan
