"""Every operator as a named query ``(spark, sf_dir) -> DataFrame`` over the whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.catalog import stage
from tripmart.operators import checks, cleaning, derivation, joins, modelling, ordering, profiling, quality, strategy
from tripmart.plans import charts, incremental, landing, publish, reports, rollups, warehouse
from tripmart.sources import encodings, files, sinks, tables
from tripmart.workspace import materialise, new_path, write_bytes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROFILED = ["passenger_count", "trip_distance", "fare_amount", "extra", "tip_amount", "total_amount"]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.raw_trips(spark, sf_dir)


def _standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.standardise(_raw(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: stage.table(spark, sf_dir, name)


_fact, _times, _payments, _vendors = (_table(n) for n in ("fact_trips", "dim_time", "dim_payment", "dim_vendor"))
_PICKUP, _DROPOFF = S.TIMESTAMP_COLUMNS


# ------------------------------------------------------------------ sources, sinks, raw zone
@query
def scan_raw(spark, sf_dir):
    return _raw(spark, sf_dir)


@query
def row_count(spark, sf_dir):
    return tables.row_count(_raw(spark, sf_dir))


@query
def schema_report(spark, sf_dir):
    return tables.schema_report(_raw(spark, sf_dir))


@query
def land_raw(spark, sf_dir):
    """One load date landed twice, another landed and then replaced by an empty batch."""
    zone = new_path(spark, "land")
    trips = _raw(spark, sf_dir)
    landing.land_trips(trips, zone, 2026, 4)
    landing.land_trips(trips, zone, 2026, 4)
    landing.land_trips(trips.limit(1000), zone, 2026, 5)
    landing.land_trips(trips.where(F.lit(False)), zone, 2026, 5)
    months = spark.createDataFrame([(2026, 4), (2026, 5)], "year int, month int")
    # a row per month meets the months: all trips of a month would meet in one task
    landed = tables.scan_trips(spark, zone).groupBy("year", "month").agg(
        F.count(_DROPOFF).alias("row_count"), F.count("fare_amount").alias("fares")
    )
    none = F.lit(0).cast("bigint")
    return months.join(landed, ["year", "month"], "left").select(
        "year", "month", F.coalesce("row_count", none).alias("row_count"), F.coalesce("fares", none).alias("fares")
    )


@query
def land_drifted(spark, sf_dir):
    """Two months whose publishers differ in the case of a name and in types, scanned together."""
    zone = new_path(spark, "drift")
    trips = _raw(spark, sf_dir)
    landing.land_trips(trips, zone, 2026, 4)
    drifted = (
        trips.withColumnRenamed("airport_fee", "Airport_fee")
        .withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        .withColumn("VendorID", F.col("VendorID").cast("int"))
        .withColumn("fare_amount", F.col("fare_amount").cast("string"))
    )
    landing.land_trips(drifted.select(*reversed(drifted.columns)), zone, 2026, 5)
    return (
        tables.scan_trips(spark, zone)
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("VendorID").alias("vendors"),
            F.sum("passenger_count").alias("passengers"),
            F.count_if(F.col("airport_fee") > 0).alias("airport_fees"),
            F.count("fare_amount").alias("fares"),
        )
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "csv")
    sinks.write_csv(_raw(spark, sf_dir), path)
    return tables.read_csv(spark, path, S.RAW_TRIPS)


@query
def csv_sample(spark, sf_dir):
    """How many rows the look at a CSV shows, and its header."""
    path = new_path(spark, "csv")
    sinks.write_csv(_raw(spark, sf_dir), path)
    sample = tables.csv_sample(spark, path)
    return sample.agg(F.count(F.lit(1)).alias("row_count")).withColumn("header", F.lit(",".join(sample.columns)))


def _by_supplier(files_df: DataFrame) -> DataFrame:
    key = F.regexp_extract("path", r"/part-s_suppkey=([0-9]+)\.[a-z]+$", 1).cast("bigint").alias("s_suppkey")
    return files_df.select(key, *[c for c in files_df.columns if c not in ("path", "modified_at")])


@query
def landing_listing(spark, sf_dir):
    return _by_supplier(files.list_files(spark, stage.supplier_files(spark, sf_dir, "plain"), "part-*"))


@query
def file_gate(spark, sf_dir):
    listing = files.list_files(spark, stage.supplier_files(spark, sf_dir, "plain"), "part-*")
    return _by_supplier(files.file_gate(listing, min_bytes=10))


@query
def file_md5(spark, sf_dir):
    return _by_supplier(files.file_md5(spark, stage.supplier_files(spark, sf_dir, "plain"), "part-*"))


@query
def file_utf8(spark, sf_dir):
    return _by_supplier(files.file_utf8(spark, stage.supplier_files(spark, sf_dir, "marked"), "part-*"))


@query
def file_tree_digest(spark, sf_dir):
    """Blocks of 8 bytes and nodes of two children, so that small files have trees of several levels."""
    folder = stage.supplier_files(spark, sf_dir, "plain")
    return _by_supplier(files.file_tree_digest(spark, folder, "part-*", block=8, fan=2))


@query
def file_encoding(spark, sf_dir):
    """Files in seven encodings, told apart with pairs of characters learned from the documents; ranges of 16 bytes, so that most
    files are cut. Is the name more likely than not?"""
    folder = stage.supplier_files(spark, sf_dir, "encoded")
    listing = files.list_files(spark, folder, "part-*").select("path", "length")
    pairs = encodings.learn_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = encodings.detect_encodings(listing, encodings.likelihoods(spark, pairs), size=16)
    return _by_supplier(found).select("s_suppkey", "encoding", (F.col("confidence") > 0.5).alias("confident"))


@query
def row_gate(spark, sf_dir):
    return checks.row_gate(_raw(spark, sf_dir))


@query
def ingest_gate(spark, sf_dir):
    """Every check of a landed folder. Smallest accepted size 1 byte: the verdict must not depend on how well the columns
    compress. The number of files depends on the number of tasks: it is checked, but not shown."""
    verdicts = landing.landing_gate(spark, stage.raw_folder(spark, sf_dir), min_bytes=1)
    return verdicts.withColumn("observed", F.when(F.col("check_name") != "files_present", F.col("observed")))


@query
def ingest_gate_csv(spark, sf_dir):
    """The same for a CSV export whose rows are there but whose folder also holds a file that claims to be Parquet."""
    path = new_path(spark, "gate")
    sinks.write_csv(_raw(spark, sf_dir), f"{path}/csv")
    write_bytes(spark, f"{path}/odd.parquet", b"no parquet")
    verdicts = landing.landing_gate(spark, path, min_bytes=1)
    return verdicts.withColumn("observed", F.when(F.col("check_name") != "files_present", F.col("observed")))


# ------------------------------------------------------------------ cleaning
@query
def clean_cast(spark, sf_dir):
    return cleaning.conform_types(_raw(spark, sf_dir)).select(*S.CLEAN_TYPES)


@query
def clean_parse_ts(spark, sf_dir):
    """The timestamps as text, as a CSV load would bring them, parsed back."""
    text = _raw(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in S.TIMESTAMP_COLUMNS])
    return cleaning.parse_timestamps(text)


@query
def q_median(spark, sf_dir):
    return stage.statistics(spark, sf_dir)


@query
def q_median_approx(spark, sf_dir):
    """For every sketch quantile, whether its rank is as close to the wanted one as promised."""
    standard, error = _standard(spark, sf_dir), 0.0001
    found = cleaning.trip_statistics(standard, "approximate", error)
    once = cleaning.as_scalar(found)
    imputed = cleaning.impute_negative_fare(standard, found)
    wanted = {
        "fare_median": (standard, "fare_amount", 0.5),
        "distance_median": (standard, "trip_distance", 0.5),
        "fare_low": (imputed, "fare_amount", 0.01),
        "fare_high": (imputed, "fare_amount", 0.99),
    }
    rows = []
    for name, (trips, column, p) in wanted.items():
        value, n = F.col(column), F.count(column)
        rows.append(
            trips.agg(
                F.lit(name).alias("statistic"),
                (
                    (F.count_if(value < once[name]) <= F.ceil(p * n) + error * n)
                    & (F.count_if(value <= once[name]) >= F.ceil(p * n) - error * n - 1)
                ).alias("within_error"),
            )
        )
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query
def clean_neg_fare(spark, sf_dir):
    trips = _standard(spark, sf_dir)
    fixed = cleaning.impute_negative_fare(trips, cleaning.trip_statistics(trips))
    return fixed.select("PULocationID", "DOLocationID", "fare_amount")


@query
def clean_neg_tip(spark, sf_dir):
    return cleaning.floor_negative_tip(_standard(spark, sf_dir)).select("PULocationID", "tip_amount")


@query
def flag_total(spark, sf_dir):
    return cleaning.flag_invalid_total(_standard(spark, sf_dir)).select("total_amount", "is_invalid_total")


@query
def clean_passengers(spark, sf_dir):
    return cleaning.fix_passengers(_standard(spark, sf_dir)).select("PULocationID", "passenger_count")


@query
def clean_zero_distance(spark, sf_dir):
    trips = _standard(spark, sf_dir)
    fixed = cleaning.impute_zero_distance(trips, cleaning.trip_statistics(trips))
    return fixed.select("PULocationID", "DOLocationID", "trip_distance")


@query
def clean_winsorise(spark, sf_dir):
    trips = _standard(spark, sf_dir)
    statistics = cleaning.trip_statistics(trips)
    fixed = cleaning.impute_negative_fare(trips, statistics).transform(cleaning.winsorise_fare, statistics)
    return fixed.select("PULocationID", "DOLocationID", "fare_amount")


@query
def derive_duration(spark, sf_dir):
    return cleaning.add_duration(_standard(spark, sf_dir)).select(
        _PICKUP, _DROPOFF, "trip_duration_min", "is_invalid_duration"
    )


@query
def drop_invalid(spark, sf_dir):
    return cleaning.kept_trips(_raw(spark, sf_dir)).select(_PICKUP, _DROPOFF, "trip_duration_min")


# ------------------------------------------------------------------ derived columns
@query
def derive_calendar(spark, sf_dir):
    return derivation.add_calendar(_standard(spark, sf_dir)).select(
        _PICKUP, "pickup_hour", "pickup_dow", "pickup_month", "pickup_date", "pickup_week", "is_weekend"
    )


@query
def derive_time_of_day(spark, sf_dir):
    return derivation.add_time_of_day(_standard(spark, sf_dir)).select(_PICKUP, "time_of_day")


@query
def derive_airport(spark, sf_dir):
    return derivation.add_airport_flag(_standard(spark, sf_dir)).select(
        "RatecodeID", "airport_fee", "is_airport_trip"
    )


@query
def derive_tip_pct(spark, sf_dir):
    return derivation.add_tip_percent(_standard(spark, sf_dir)).select("fare_amount", "tip_amount", "tip_pct")


@query
def derive_revenue(spark, sf_dir):
    return derivation.add_revenue(_standard(spark, sf_dir)).select(
        "fare_amount", *S.SURCHARGES, "revenue_excl_tip"
    )


@query
def derive_distance_bucket(spark, sf_dir):
    return derivation.add_distance_bucket(_standard(spark, sf_dir)).select("trip_distance", "distance_bucket")


@query
def derive_labels(spark, sf_dir):
    return derivation.add_labels(_standard(spark, sf_dir)).select(
        "payment_type", "RatecodeID", "payment_label", "rate_label"
    )


@query
def surrogate_id(spark, sf_dir):
    """Ids over the whole fact: as many distinct ones as rows."""
    return _fact(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("trip_id").alias("distinct_ids")
    )


@query
def stable_ids(spark, sf_dir):
    """Every raw trip with its number in the order of all columns."""
    raw = _raw(spark, sf_dir)
    return ordering.numbered(raw, [ordering.ascending(c) for c in raw.columns], "trip_number").select(
        "trip_number", _DROPOFF, "PULocationID", "fare_amount", "total_amount"
    )


@query
def rank_trips(spark, sf_dir):
    """Every raw trip with its rank by total amount."""
    return ordering.ranked(_raw(spark, sf_dir), [ordering.descending("total_amount")], "total_rank").select(
        "total_rank", "total_amount", "PULocationID"
    )


@query
def publish_snapshot(spark, sf_dir):
    """A published warehouse: a version, one that replaces the fact by its valid trips, a job that dies before it publishes, and one
    that began before the second version and is refused. Rows of the tables of both versions, as read."""
    whole = publish.Published(spark, new_path(spark, "published"))
    raw = _raw(spark, sf_dir)
    first = whole.update(lambda folder: warehouse.build_warehouse(raw, folder))

    def valid(folder):
        trips = whole.read("fact_trips").where("NOT is_invalid_total")
        return {"fact_trips": sinks.write_table(trips, f"{folder}/fact_trips", ["pickup_month"])}

    second = whole.update(valid)
    vendors = _vendors(spark, sf_dir).limit(1)
    sinks.write_table(vendors, f"{whole.begin()}/dim_vendor")
    late = whole.begin()
    try:
        whole.publish(late, {"dim_vendor": sinks.write_table(vendors, f"{late}/dim_vendor")}, after=first.number)
        refused = False
    except publish.Conflict:
        refused = True
    counted = [
        whole.read(name, v.number).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(v.number).alias("version"), F.lit(name).alias("table_name"), "row_count",
            F.lit(whole.version().number == second.number and refused).alias("as_published"),
        )
        for v in (first, second)
        for name in S.TABLES
    ]
    return reduce(DataFrame.unionByName, counted)


# ------------------------------------------------------------------ star schema
@query
def fact_trips(spark, sf_dir):
    return _fact(spark, sf_dir).select(*[target for _, target in S.FACT_COLUMNS])


@query
def dim_time(spark, sf_dir):
    return modelling.dim_time(_fact(spark, sf_dir))


@query
def dim_location(spark, sf_dir):
    return modelling.dim_location(_fact(spark, sf_dir))


@query
def dim_payment(spark, sf_dir):
    return modelling.dim_payment(cleaning.kept_trips(_raw(spark, sf_dir)))


@query
def wh_roundtrip(spark, sf_dir):
    """Rows of every table as read back from storage."""
    counted = [
        stage.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in S.TABLES
    ]
    whole = counted[0]
    for part in counted[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def wh_partitioned(spark, sf_dir):
    """Partition sizes as read back; the key comes from the folder names."""
    return _fact(spark, sf_dir).groupBy("pickup_month").agg(F.count(F.lit(1)).alias("row_count"))


@query
def etl_end_to_end(spark, sf_dir):
    """The whole job, into a new warehouse every time."""
    return warehouse.run_warehouse_job(_raw(spark, sf_dir), new_path(spark, "job"), statistics=stage.statistics(spark, sf_dir))


@query
def prune_zone_day(spark, sf_dir):
    """Trips of some zones on some days, from a fact clustered by day and zone within its months: by month of pickup."""
    path = new_path(spark, "clustered")
    near = sinks.curve(F.dayofmonth("date_key"), F.col("pickup_location_id"))
    sinks.write_clustered(_fact(spark, sf_dir), path, "pickup_month", near, files=24)
    wanted = "pickup_month IN (2, 3) AND date_key BETWEEN DATE'1995-02-10' AND DATE'1996-03-20' AND pickup_location_id <= 5"
    return spark.read.parquet(path).where(wanted).groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("pickup_location_id").alias("zones")
    )


@query
def etl_incremental(spark, sf_dir):
    """The fact after three batches were taken in one after the other: that of all trips at once."""
    raw, zone = _raw(spark, sf_dir), new_path(spark, "zone")
    whole = publish.Published(spark, new_path(spark, "grown"))
    for month, part in ((4, 0), (5, 1), (6, 2)):
        incremental.take_in(raw.where(F.pmod("PULocationID", F.lit(3)) == part), zone, whole, 2026, month)
    return incremental.fact(whole).select(*[target for _, target in S.FACT_COLUMNS])


# ------------------------------------------------------------------ joins and reports
@query
def join_vendor(spark, sf_dir):
    return joins.with_vendor(_fact(spark, sf_dir), _vendors(spark, sf_dir)).select(
        "vendor_id", "vendor_name", "date_key", "total_amount"
    )


@query
def join_location_roles(spark, sf_dir):
    return joins.with_location_roles(_fact(spark, sf_dir), stage.table(spark, sf_dir, "dim_location")).select(
        "pickup_location_id", "dropoff_location_id", "pickup_role", "dropoff_role", "total_amount"
    )


@query
def q1_revenue_by_period(spark, sf_dir):
    return reports.revenue_by_period(stage.rollup(spark, sf_dir, "time_of_day", "is_invalid_total"))


@query
def q1_of_months(spark, sf_dir):
    """The report on three months, which are all that is read of the fact."""
    return reports.revenue_by_period(reports.of_months(_fact(spark, sf_dir), 6, 7, 8))


@query
def q1_within_months(spark, sf_dir):
    return reports.revenue_by_period(_fact(spark, sf_dir), "pickup_month")


@query
def q4_of_months(spark, sf_dir):
    """Zones of one month, from partial aggregates."""
    days = stage.rollup(spark, sf_dir, "pickup_location_id", "date_key", "pickup_month", "is_invalid_total")
    return reports.top_zones(reports.of_months(days, 12))


@query
def q2_tip_by_distance(spark, sf_dir):
    return reports.tip_by_distance(stage.rollup(spark, sf_dir, "distance_bucket", "payment_key"), _payments(spark, sf_dir))


@query
def q2_top_band(spark, sf_dir):
    return reports.top_tipping_band(_fact(spark, sf_dir), _payments(spark, sf_dir))


@query
def q3_hourly_demand(spark, sf_dir):
    return reports.hourly_demand(stage.rollup(spark, sf_dir, "pickup_hour", "is_weekend"))


@query
def q3_hourly_sql(spark, sf_dir):
    """The hourly report as SQL text over the registered tables."""
    tables.register_views({"fact_trips": _fact(spark, sf_dir)})
    return spark.sql(
        """
        SELECT pickup_hour, is_weekend, COUNT(*) AS trip_count,
               CAST(ROUND(CAST(AVG(fare_amount) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_fare,
               CAST(ROUND(CAST(AVG(trip_duration_min) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_duration,
               CAST(ROUND(CAST(SUM(total_amount) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS total_revenue
        FROM fact_trips GROUP BY pickup_hour, is_weekend ORDER BY pickup_hour, is_weekend
        """
    )


@query
def q4_top_zones(spark, sf_dir):
    return reports.top_zones(stage.rollup(spark, sf_dir, "pickup_location_id", "date_key", "is_invalid_total"))


@query
def q5_airport_trend(spark, sf_dir):
    return reports.airport_trend(stage.rollup(spark, sf_dir, "pickup_month", "pickup_dow", "is_airport_trip", "is_invalid_total"))


@query
def q5_iso_week(spark, sf_dir):
    return reports.airport_iso_weeks(stage.rollup(spark, sf_dir, "date_key", "is_airport_trip", "is_invalid_total"), _times(spark, sf_dir))


@query
def vendor_revenue(spark, sf_dir):
    return reports.vendor_revenue(stage.rollup(spark, sf_dir, "vendor_id"), _vendors(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return reports.preview(q5_airport_trend(spark, sf_dir))


@query
def active_days(spark, sf_dir):
    """Days with valid trips by zone, by groups of ten zones and by year, all from one table of bits."""
    bits = materialise(rollups.day_bitmaps(_fact(spark, sf_dir)), "day-bitmaps")
    zone, group, year = F.col("pickup_location_id"), F.floor(F.col("pickup_location_id") / 10), F.col("pickup_year")
    parts = [
        rollups.active_days(bits, key.cast("bigint").alias("key")).select(F.lit(name).alias("by"), "key", "active_days")
        for name, key in (("zone", zone), ("group", group), ("year", year))
    ]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ chart feeds
@query
def chart_hourly(spark, sf_dir):
    return charts.hourly_series(q3_hourly_demand(spark, sf_dir))


@query
def chart_period(spark, sf_dir):
    return charts.period_bars(q1_revenue_by_period(spark, sf_dir))


@query
def chart_tip_heatmap(spark, sf_dir):
    return charts.tip_heatmap(q2_tip_by_distance(spark, sf_dir))


@query
def chart_top10_zones(spark, sf_dir):
    return charts.zone_bars(q4_top_zones(spark, sf_dir))


@query
def chart_payment_share(spark, sf_dir):
    return charts.payment_share(q2_tip_by_distance(spark, sf_dir))


@query
def chart_airport_means(spark, sf_dir):
    return charts.airport_means(q5_airport_trend(spark, sf_dir))


@query
def chart_tip_period(spark, sf_dir):
    return charts.tip_by_period(q1_revenue_by_period(spark, sf_dir))


@query
def chart_rank_scatter(spark, sf_dir):
    return charts.rank_scatter(q4_top_zones(spark, sf_dir))


# ------------------------------------------------------------------ validation and quality
def _verdicts(spark, sf_dir):
    built = stage.warehouse(spark, sf_dir)
    return warehouse.validate_warehouse(spark, built.base, built.counts)


@query
def validate_counts(spark, sf_dir):
    return _verdicts(spark, sf_dir).where("check_name = 'row_count'").select(
        "table_name", "expected", "observed", "passed"
    )


@query
def validate_nulls(spark, sf_dir):
    return _verdicts(spark, sf_dir).where("check_name = 'not_null'").select(
        "table_name", "column_name", F.col("observed").alias("nulls"), "severity", "passed"
    )


@query
def validate_all(spark, sf_dir):
    return quality.overall(_verdicts(spark, sf_dir))


@query
def validate_wrong_count(spark, sf_dir):
    """A fact table that was expected to have one row more fails its count, and only that."""
    built = stage.warehouse(spark, sf_dir)
    expected = {**built.counts, "fact_trips": built.counts["fact_trips"] + 1}
    return warehouse.validate_warehouse(spark, built.base, expected).where("check_name = 'row_count'").select(
        "table_name", "expected", "observed", "passed"
    )


@query
def validate_unreadable(spark, sf_dir):
    """A warehouse in which ``dim_time`` holds something else than Parquet: it fails as a whole, the others are checked."""
    base = new_path(spark, "unreadable")
    for name in S.TABLES:
        rows = stage.table(spark, sf_dir, name)
        if name == "dim_time":
            rows.select(F.lit("no parquet")).limit(1).write.text(f"{base}/{name}")
        else:
            rows.write.parquet(f"{base}/{name}")
    verdicts = warehouse.validate_warehouse(spark, base, stage.warehouse(spark, sf_dir).counts)
    return verdicts.select(
        "table_name", "check_name", "column_name", "observed", "passed", F.col("error").isNotNull().alias("has_error")
    )


@query
def row_lineage(spark, sf_dir):
    return quality.row_lineage(_raw(spark, sf_dir))


@query
def dq_findings(spark, sf_dir):
    return quality.dq_findings(_raw(spark, sf_dir))


@query
def cleaning_strategy(spark, sf_dir):
    return strategy.cleaning_strategy(_raw(spark, sf_dir), stage.statistics(spark, sf_dir))


# ------------------------------------------------------------------ profiling
@query
def profile_missing(spark, sf_dir):
    return profiling.missing_values(_raw(spark, sf_dir))


@query
def profile_stats(spark, sf_dir):
    return profiling.numeric_stats(_raw(spark, sf_dir), PROFILED)


@query
def profile_histogram(spark, sf_dir):
    return profiling.histogram(_raw(spark, sf_dir), PROFILED)


@query
def profile_kde(spark, sf_dir):
    return profiling.kernel_density(_raw(spark, sf_dir), PROFILED)


@query
def profile_duplicates(spark, sf_dir):
    return profiling.duplicate_summary(_raw(spark, sf_dir))


@query
def profile_outliers(spark, sf_dir):
    return profiling.outliers(_raw(spark, sf_dir), PROFILED)


@query
def profile_missing_matrix(spark, sf_dir):
    """Blocks are the months of the dropoff, the one timestamp that is always set."""
    raw = _raw(spark, sf_dir)
    return profiling.missing_matrix(raw, F.trunc(_DROPOFF, "month"), raw.columns)


@query
def profile_bottom_sample(spark, sf_dir):
    """The 500 order lines with the smallest hash of their keys."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*keys)
    return profiling.bottom_sample(lines, 500, F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])))


@query
def profile_missing_together(spark, sf_dir):
    return profiling.missing_together(_raw(spark, sf_dir))


@query
def profile_sample(spark, sf_dir):
    """For two sizes: rows drawn, and how many of these are rows of the table (a row no more often than there)."""
    raw = _raw(spark, sf_dir)
    mark = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in raw.columns]).alias("mark")

    def drawn(size: int) -> DataFrame:
        sample = profiling.profile_sample(raw, size).groupBy(mark).agg(F.count(F.lit(1)).alias("drawn"))
        # a sample is bounded by its size, so it may be broadcast to the table
        there = raw.select(mark).join(F.broadcast(sample), "mark").groupBy("mark", "drawn").agg(F.count(F.lit(1)).alias("n"))
        return there.agg(
            F.lit(size).cast("bigint").alias("size"),
            F.sum("drawn").alias("sampled"),
            F.sum(F.least("drawn", "n")).alias("found_in_table"),
        )

    return drawn(200_000).unionByName(drawn(500))
