"""The same results in plain SQL for an embedded SQL engine, written independently of the Spark code.

Each oracle is a chain of named subqueries ending in one SELECT. Numbers are rounded through DECIMAL on both sides.
"""

from __future__ import annotations


def r(value: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def bigint(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def integer(value: str) -> str:
    return f"CAST({value} AS INTEGER)"


_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    """Declare a named subquery and the ones it reads."""
    _PARTS[name] = (needs, sql)


def oracle(select: str, *needs: str) -> str:
    """``select`` in front of which every needed subquery is declared once, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for inner in _PARTS[name][0]:
            visit(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    declared = ",\n".join(f"{name} AS (\n{_PARTS[name][1]}\n)" for name in ordered)
    return f"WITH {declared}\n{select}" if declared else select


# ------------------------------------------------------------------ input
part(
    "keyed",
    """SELECT *, 7 * l_orderkey + 13 * l_partkey + 31 * CAST(l_linenumber AS BIGINT) AS k
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
part(
    "trips",
    """SELECT
  CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 6 END AS BIGINT) AS VendorID,
  CASE WHEN k % 97 = 0 THEN NULL ELSE o_orderdate + (k % 1440) * INTERVAL '1' MINUTE END AS tpep_pickup_datetime,
  o_orderdate + (k % 1440 + CASE WHEN k % 41 = 0 THEN -1 WHEN k % 43 = 0 THEN 0 ELSE 1 + k % 90 END)
    * INTERVAL '1' MINUTE AS tpep_dropoff_datetime,
  CAST(CASE WHEN k % 29 = 0 THEN NULL WHEN k % 23 = 0 THEN 0 WHEN k % 31 = 0 THEN 9 ELSE 1 + k % 4 END AS DOUBLE)
    AS passenger_count,
  CASE WHEN k % 101 = 0 THEN NULL WHEN k % 37 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity * CAST(0.3 AS DOUBLE) END
    AS trip_distance,
  CAST(CASE WHEN k % 67 = 0 THEN NULL WHEN k % 71 = 0 THEN 99 ELSE 1 + k % 6 END AS DOUBLE) AS RatecodeID,
  l_suppkey AS PULocationID,
  o_custkey % 265 AS DOLocationID,
  CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
  CASE WHEN k % 103 = 0 THEN NULL WHEN k % 53 = 0 THEN -l_extendedprice / 1000 ELSE l_extendedprice / 1000 END
    AS fare_amount,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(k % 3 AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS extra,
  CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
  CASE WHEN k % 59 = 0 THEN CAST(-1 AS DOUBLE) ELSE l_extendedprice * l_discount / 1000 END AS tip_amount,
  CASE WHEN k % 13 = 0 THEN CAST(6.55 AS DOUBLE) END AS tolls_amount,
  CASE WHEN k % 47 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END AS improvement_surcharge,
  CASE WHEN k % 61 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 107 = 0 THEN NULL
       ELSE l_extendedprice * (1 + l_tax) / 1000 END AS total_amount,
  CASE WHEN k % 7 <> 0 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
  CASE WHEN k % 10 = 0 THEN CAST(1.25 AS DOUBLE) WHEN k % 11 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS airport_fee
FROM keyed""",
    "keyed",
)

# ------------------------------------------------------------------ cleaning
part(
    "std",
    """SELECT * REPLACE (CAST(passenger_count AS INTEGER) AS passenger_count, CAST(RatecodeID AS INTEGER) AS RatecodeID),
  CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60 AS trip_duration_min
FROM trips""",
    "trips",
)
part(
    "medians",
    """SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY fare_amount) AS fare_median,
  percentile_disc(0.5) WITHIN GROUP (ORDER BY trip_distance) AS distance_median
FROM std""",
    "std",
)
part(
    "imputed",
    """SELECT std.* REPLACE (CASE WHEN fare_amount < 0 THEN fare_median ELSE fare_amount END AS fare_amount)
FROM std, medians""",
    "std",
    "medians",
)
part(
    "bounds",
    """SELECT percentile_disc(0.01) WITHIN GROUP (ORDER BY fare_amount) AS fare_low,
  percentile_disc(0.99) WITHIN GROUP (ORDER BY fare_amount) AS fare_high
FROM imputed""",
    "imputed",
)
part(
    "clean",
    """SELECT imputed.* REPLACE (
    LEAST(GREATEST(fare_amount, fare_low), fare_high) AS fare_amount,
    CASE WHEN tip_amount < 0 THEN CAST(0 AS DOUBLE) ELSE tip_amount END AS tip_amount,
    LEAST(CASE WHEN passenger_count IS NULL OR passenger_count = 0 THEN 1 ELSE passenger_count END, 6)
      AS passenger_count,
    CASE WHEN trip_distance = 0 THEN distance_median ELSE trip_distance END AS trip_distance),
  total_amount <= 0 AS is_invalid_total
FROM imputed, medians, bounds
WHERE trip_duration_min > 0""",
    "imputed",
    "medians",
    "bounds",
)


def period(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 6 AND 9 THEN 'Morning Rush' WHEN {hour} BETWEEN 10 AND 15 THEN 'Midday' "
        f"WHEN {hour} BETWEEN 16 AND 19 THEN 'Evening Rush' WHEN {hour} BETWEEN 20 AND 23 THEN 'Night' "
        "ELSE 'Late Night' END"
    )


def bucket(miles: str) -> str:
    return (
        f"CASE WHEN {miles} < 1 THEN '< 1 mi' WHEN {miles} < 3 THEN '1–3 mi' WHEN {miles} < 5 THEN '3–5 mi' "
        f"WHEN {miles} < 10 THEN '5–10 mi' ELSE '> 10 mi' END"
    )


def payment_label(code: str) -> str:
    return (
        f"CASE {code} WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge' "
        "WHEN 4 THEN 'Dispute' ELSE 'Unknown' END"
    )


def rate_label(code: str) -> str:
    return (
        f"CASE {code} WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' "
        "WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated' WHEN 6 THEN 'Group Ride' ELSE 'Unknown' END"
    )


HOUR = integer("EXTRACT(hour FROM tpep_pickup_datetime)")
DOW = integer("EXTRACT(dow FROM tpep_pickup_datetime) + 1")
MONTH = integer("EXTRACT(month FROM tpep_pickup_datetime)")
WEEK = integer("EXTRACT(week FROM tpep_pickup_datetime)")
DAY = "CAST(tpep_pickup_datetime AS DATE)"
AIRPORT = "(RatecodeID IN (2, 3) OR airport_fee > 0)"
TIP_PCT = f"CASE WHEN fare_amount > 0 THEN {r('tip_amount / fare_amount * 100')} ELSE CAST(0 AS DOUBLE) END"
REVENUE = "fare_amount" + "".join(
    f" + COALESCE({c}, CAST(0 AS DOUBLE))"
    for c in (
        "extra",
        "mta_tax",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "airport_fee",
    )
)

# ------------------------------------------------------------------ warehouse
part(
    "fact",
    f"""SELECT {DAY} AS date_key, PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
  payment_type AS payment_key, VendorID AS vendor_id, trip_distance, trip_duration_min, passenger_count, fare_amount,
  tip_amount, {TIP_PCT} AS tip_pct, tolls_amount, total_amount, {REVENUE} AS revenue_excl_tip, congestion_surcharge,
  airport_fee, {period(HOUR)} AS time_of_day, {DOW} IN (1, 7) AS is_weekend, {AIRPORT} AS is_airport_trip,
  is_invalid_total, {bucket('trip_distance')} AS distance_bucket, {HOUR} AS pickup_hour, {MONTH} AS pickup_month,
  {DOW} AS pickup_dow
FROM clean""",
    "clean",
)
part(
    "dim_time",
    f"""SELECT DISTINCT {DAY} AS date_key, {HOUR} AS hour, {DOW} AS day_of_week, {MONTH} AS month,
  {WEEK} AS week_of_year, {period(HOUR)} AS time_of_day, {DOW} IN (1, 7) AS is_weekend,
  dayname(tpep_pickup_datetime) AS day_name, monthname(tpep_pickup_datetime) AS month_name
FROM clean""",
    "clean",
)
part(
    "dim_location",
    """SELECT PULocationID AS location_id, 'pickup' AS location_type FROM clean
UNION
SELECT DOLocationID, 'dropoff' FROM clean""",
    "clean",
)
part(
    "dim_payment",
    f"""SELECT DISTINCT payment_type AS payment_key, {payment_label('payment_type')} AS payment_label,
  {rate_label('RatecodeID')} AS rate_label, RatecodeID AS rate_code
FROM clean""",
    "clean",
)
part(
    "dim_vendor",
    """SELECT CAST(1 AS BIGINT) AS vendor_id, 'Creative Mobile Technologies' AS vendor_name
UNION ALL SELECT CAST(2 AS BIGINT), 'VeriFone Inc.'""",
)
TABLES = ("fact", "dim_time", "dim_location", "dim_payment", "dim_vendor")
part(
    "table_counts",
    "\nUNION ALL ".join(
        f"SELECT '{'fact_trips' if t == 'fact' else t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES
    ),
    *TABLES,
)
part(
    "null_counts",
    "\nUNION ALL ".join(
        f"SELECT '{'fact_trips' if t == 'fact' else t}' AS table_name, '{c}' AS column_name, "
        f"COUNT(*) - COUNT({c}) AS nulls FROM {t}"
        for t, c in (
            ("fact", "date_key"),
            ("fact", "pickup_location_id"),
            ("fact", "fare_amount"),
            ("fact", "total_amount"),
            ("dim_time", "date_key"),
            ("dim_time", "hour"),
            ("dim_location", "location_id"),
            ("dim_payment", "payment_key"),
            ("dim_vendor", "vendor_id"),
        )
    ),
    *TABLES,
)
part(
    "lineage",
    f"""SELECT COUNT(*) AS raw_rows,
  COUNT(*) FILTER (WHERE trip_duration_min > 0) AS kept_rows,
  COUNT(*) FILTER (WHERE trip_duration_min <= 0) AS dropped_invalid,
  COUNT(*) FILTER (WHERE trip_duration_min IS NULL) AS dropped_unknown,
  COUNT(*) FILTER (WHERE trip_duration_min <= 0 OR trip_duration_min IS NULL) AS dropped_rows,
  {r("CAST(COUNT(*) FILTER (WHERE trip_duration_min <= 0 OR trip_duration_min IS NULL) AS DOUBLE) / COUNT(*) * 100")}
    AS dropped_pct
FROM std""",
    "std",
)
part(
    "verdict",
    """SELECT CAST(5 + COUNT(*) AS BIGINT) AS checks, CAST(0 AS BIGINT) AS errors,
  COUNT(*) FILTER (WHERE nulls > 0) AS warnings, TRUE AS all_passed
FROM null_counts""",
    "null_counts",
)

# ------------------------------------------------------------------ reports
def _revenue_by_period(where: str, within: str = "") -> str:
    per = f"PARTITION BY {within} " if within else ""
    keys = ", ".join(filter(None, (within, "time_of_day")))
    return f"""SELECT {keys}, COUNT(*) AS trip_count, {r('SUM(total_amount)')} AS total_revenue,
  {r('AVG(fare_amount)')} AS avg_fare, {r('AVG(tip_pct)')} AS avg_tip_pct,
  {r('AVG(trip_duration_min)')} AS avg_duration_min,
  {integer(f'RANK() OVER ({per}ORDER BY SUM(total_amount) DESC)')} AS revenue_rank
FROM fact WHERE is_invalid_total = FALSE AND {where} GROUP BY {keys}"""


part("q1", _revenue_by_period("TRUE"), "fact")
part(
    "q2",
    f"""SELECT distance_bucket, payment_label, {r('AVG(tip_pct)')} AS avg_tip_pct, COUNT(*) AS trip_count,
  {r('AVG(fare_amount)')} AS avg_fare,
  {integer('ROW_NUMBER() OVER (PARTITION BY payment_label ORDER BY AVG(tip_pct) DESC, distance_bucket)')}
    AS top_tipping_rank_within_payment
FROM (SELECT *, {payment_label('payment_key')} AS payment_label FROM fact)
WHERE payment_label IN ('Credit Card', 'Cash')
GROUP BY distance_bucket, payment_label""",
    "fact",
)
part(
    "q3",
    f"""SELECT pickup_hour, is_weekend, COUNT(*) AS trip_count, {r('AVG(fare_amount)')} AS avg_fare,
  {r('AVG(trip_duration_min)')} AS avg_duration, {r('SUM(total_amount)')} AS total_revenue
FROM fact GROUP BY pickup_hour, is_weekend""",
    "fact",
)
def _top_zones(where: str) -> str:
    return f"""SELECT * FROM (
  SELECT pickup_location_id, {r('AVG(daily)')} AS avg_daily_revenue, {r('SUM(daily)')} AS total_revenue,
    COUNT(DISTINCT date_key) AS active_days, {integer('RANK() OVER (ORDER BY AVG(daily) DESC)')} AS revenue_rank
  FROM (SELECT pickup_location_id, date_key, SUM(total_amount) AS daily FROM fact
        WHERE is_invalid_total = FALSE AND {where} GROUP BY pickup_location_id, date_key)
  GROUP BY pickup_location_id)
WHERE revenue_rank <= 15"""


part("q4", _top_zones("TRUE"), "fact")
_TREND = f"""COUNT(*) AS trip_count, {r('AVG(fare_amount)')} AS avg_fare, {r('AVG(trip_distance)')} AS avg_distance,
    {r('AVG(tip_pct)')} AS avg_tip_pct, {r('SUM(total_amount)')} AS total_revenue
  FROM fact WHERE is_invalid_total = FALSE"""


def _lagged(inner: str, order: str) -> str:
    before = f"LAG(total_revenue) OVER (PARTITION BY is_airport_trip ORDER BY {order})"
    change = r(f"(total_revenue - {before}) / NULLIF({before}, 0) * 100")
    return f"SELECT *, {before} AS prev_period_revenue, {change} AS revenue_pct_change FROM ({inner})"


part(
    "q5",
    _lagged(
        f"SELECT pickup_month, pickup_dow AS day_of_week, is_airport_trip, {_TREND}\n"
        "  GROUP BY pickup_month, pickup_dow, is_airport_trip",
        "pickup_month, day_of_week",
    ),
    "fact",
)
part(
    "q5_weeks",
    _lagged(
        f"SELECT {integer('EXTRACT(isoyear FROM date_key)')} AS iso_year, "
        f"{integer('EXTRACT(week FROM date_key)')} AS week_of_year, is_airport_trip, {_TREND}\n"
        "  GROUP BY 1, 2, 3",
        "iso_year, week_of_year",
    ),
    "fact",
)

# ------------------------------------------------------------------ profiling
PROFILED = ("passenger_count", "trip_distance", "fare_amount", "extra", "tip_amount", "total_amount")
part(
    "values_of",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM trips WHERE {c} IS NOT NULL" for c in PROFILED
    ),
    "trips",
)
part("value_ranges", "SELECT column_name, MIN(v) AS low, MAX(v) AS high FROM values_of GROUP BY column_name", "values_of")


def binned(bins: int) -> str:
    return f"""SELECT column_name,
  {integer(f'LEAST(FLOOR((v - low) / (high - low) * {bins}) + 1, {bins})')} AS bin, COUNT(*) AS n
FROM values_of JOIN value_ranges USING (column_name) GROUP BY 1, 2"""


part("bins20", binned(20), "values_of", "value_ranges")
part("bins64", binned(64), "values_of", "value_ranges")
part(
    "spread",
    """SELECT column_name, MIN(v) AS low, MAX(v) AS high, COUNT(*) AS total, STDDEV_SAMP(v) AS std,
  percentile_disc(0.25) WITHIN GROUP (ORDER BY v) AS q1, percentile_disc(0.75) WITHIN GROUP (ORDER BY v) AS q3
FROM values_of GROUP BY column_name""",
    "values_of",
)
part(
    "bandwidth",
    """SELECT *, (high - low) / 64 AS width,
  0.9 * LEAST(std, NULLIF(q3 - q1, 0) / 1.34) * POWER(CAST(total AS DOUBLE), -0.2) AS h
FROM spread""",
    "spread",
)

RAW_COLUMNS = (
    ("VendorID", "bigint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
)
RAW_LIST = ", ".join(c for c, _ in RAW_COLUMNS)

_schema_rows = "\nUNION ALL ".join(
    f"SELECT {integer(str(i))} AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS row_count, "
    f"COUNT({c}) AS non_null, COUNT({c}) < COUNT(*) AS has_nulls FROM trips"
    for i, (c, t) in enumerate(RAW_COLUMNS, start=1)
)
_missing_rows = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing, "
    f"{r(f'CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100')} AS missing_pct FROM trips"
    for c, _ in RAW_COLUMNS
)
_matrix_rows = "\nUNION ALL ".join(
    f"SELECT CAST(date_trunc('month', tpep_dropoff_datetime) AS DATE) AS block, COUNT(*) AS block_rows, "
    f"'{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing, "
    f"{r(f'CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100')} AS missing_pct FROM trips GROUP BY 1"
    for c, _ in RAW_COLUMNS
)
_FINDINGS = {
    "negative_fare": "fare_amount < 0",
    "null_fare": "fare_amount IS NULL",
    "negative_tip": "tip_amount < 0",
    "nonpositive_total": "total_amount <= 0",
    "null_total": "total_amount IS NULL",
    "missing_passengers": "passenger_count IS NULL OR passenger_count = 0",
    "negative_passengers": "passenger_count < 0",
    "too_many_passengers": "passenger_count > 6",
    "zero_distance": "trip_distance = 0",
    "negative_distance": "trip_distance < 0",
    "null_distance": "trip_distance IS NULL",
    "nonpositive_duration": "trip_duration_min <= 0",
    "unknown_duration": "trip_duration_min IS NULL",
}
_finding_rows = "\nUNION ALL ".join(
    f"SELECT '{name}' AS finding, COUNT(*) FILTER (WHERE {rule}) AS row_count, "
    f"{r(f'CAST(COUNT(*) FILTER (WHERE {rule}) AS DOUBLE) / COUNT(*) * 100')} AS pct FROM std"
    for name, rule in _FINDINGS.items()
)


#: finding, column, routine action, value put in, reason
_ROUTINE = (
    ("negative_fare", "fare_amount", "impute", "fare_median", "a refund or a typing error; the median is not moved by extremes"),
    ("null_fare", "fare_amount", "cap", "fare_low", "an unknown fare is raised to the lower bound with the extremes"),
    ("extreme_fare", "fare_amount", "cap", "NULL", "beyond the 1st and 99th percentile, which would rule the averages"),
    ("negative_tip", "tip_amount", "replace", "0", "a tip cannot be negative; none was given"),
    ("nonpositive_total", "total_amount", "flag", "NULL", "the trip took place; reports on revenue leave it out"),
    ("null_total", "total_amount", "keep", "NULL", "the flag stays unknown; reports on revenue leave it out"),
    ("missing_passengers", "passenger_count", "replace", "1", "most trips have one passenger"),
    ("negative_passengers", "passenger_count", "keep", "NULL", "not seen in the data; counted so that it would be noticed"),
    ("too_many_passengers", "passenger_count", "cap", "6", "more than a cab may legally carry"),
    ("zero_distance", "trip_distance", "impute", "distance_median", "the meter failed; the trip took time and money"),
    ("negative_distance", "trip_distance", "keep", "NULL", "falls into the shortest bucket; counted so that it would be noticed"),
    ("null_distance", "trip_distance", "keep", "NULL", "has no bucket of its own worth inventing"),
    ("nonpositive_duration", "trip_duration_min", "drop", "NULL", "ends before it begins, so neither time can be trusted"),
    ("unknown_duration", "trip_duration_min", "drop", "NULL", "has no place in a calendar"),
)
_EXTREME = {"extreme_fare": "fare_amount >= 0 AND (fare_amount < (SELECT fare_low FROM bounds) OR fare_amount > (SELECT fare_high FROM bounds))"}
_strategy_rows = "\nUNION ALL ".join(
    f"SELECT '{name}' AS finding, '{column}' AS column_name, n AS row_count, {r('CAST(n AS DOUBLE) / total * 100')} AS pct, "
    f"CASE WHEN n = 0 THEN 'none' WHEN n * 100 > total * 20 THEN 'investigate' ELSE '{action}' END AS action, "
    f"{r(f'CASE WHEN n > 0 THEN {value} END', 6)} AS replacement, '{why}' AS reason, "
    f"(SELECT COUNT(*) FROM clean WHERE {rule}) AS rows_left "
    f"FROM (SELECT COUNT(*) FILTER (WHERE {rule}) AS n, COUNT(*) AS total FROM std), medians, bounds"
    for name, column, action, value, why in _ROUTINE
    for rule in [(_FINDINGS | _EXTREME)[name]]
)

_GATE = (
    "SELECT 'files_present' AS check_name, NULL::BIGINT AS observed, CAST(1 AS BIGINT) AS required, TRUE AS passed "
    "UNION ALL SELECT 'bad_extensions', 0, 0, TRUE UNION ALL SELECT 'small_files', 0, 0, TRUE "
    "UNION ALL SELECT 'not_utf8', 0, 0, TRUE UNION ALL SELECT 'row_count', COUNT(*), 500000, COUNT(*) >= 500000 FROM trips"
)


def oracles() -> dict[str, str]:
    """Query name -> SQL. File listings, checksums, sketches and samples have none."""
    ts = "tpep_pickup_datetime, tpep_dropoff_datetime"
    low_fence, high_fence = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return {
        "scan_raw": oracle(f"SELECT {RAW_LIST} FROM trips", "trips"),
        "csv_roundtrip": oracle(f"SELECT {RAW_LIST} FROM trips", "trips"),
        "row_count": oracle("SELECT COUNT(*) AS row_count FROM trips", "trips"),
        "schema_report": oracle(_schema_rows, "trips"),
        "land_raw": oracle(
            "SELECT CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month, COUNT(*) AS row_count, "
            "COUNT(fare_amount) AS fares FROM trips UNION ALL SELECT 2026, 5, 0, 0",
            "trips",
        ),
        "land_drifted": oracle(
            "SELECT CAST(unnest([4, 5]) AS INTEGER) AS month, t.* FROM (SELECT COUNT(*) AS row_count, "
            "CAST(SUM(VendorID) AS BIGINT) AS vendors, SUM(passenger_count) AS passengers, "
            "COUNT(*) FILTER (WHERE airport_fee > 0) AS airport_fees, COUNT(fare_amount) AS fares FROM trips) t",
            "trips",
        ),
        "csv_sample": oracle(
            f"SELECT LEAST(COUNT(*), 10) AS row_count, '{RAW_LIST.replace(' ', '')}' AS header FROM trips", "trips"
        ),
        "landing_listing": "SELECT s_suppkey, CAST(LENGTH(s_name) + 1 AS BIGINT) AS length FROM supplier",
        "file_gate": "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'csv' ELSE 'txt' END AS extension, "
        "CAST(LENGTH(s_name) + 1 AS BIGINT) AS length, s_suppkey % 2 = 0 AS extension_ok, "
        "LENGTH(s_name) + 1 >= 10 AS size_ok, s_suppkey % 2 = 0 AND LENGTH(s_name) + 1 >= 10 AS passed FROM supplier",
        "active_days": oracle(
            "SELECT CAST(k.by AS VARCHAR) AS \"by\", CAST(k.key AS BIGINT) AS key, COUNT(DISTINCT date_key) AS active_days "
            "FROM (SELECT date_key, unnest([{'by': 'zone', 'key': pickup_location_id}, {'by': 'group', 'key': pickup_location_id // 10}, "
            "{'by': 'year', 'key': CAST(EXTRACT(year FROM date_key) AS BIGINT)}]) AS k FROM fact WHERE is_invalid_total = FALSE) "
            "GROUP BY k.by, k.key",
            "fact",
        ),
        "profile_bottom_sample": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem "
        "ORDER BY md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)) LIMIT 500",
        "profile_missing_together": oracle(
            "\nUNION ALL ".join(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS both_missing, "
                + r(f"CAST(COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS DOUBLE) / COUNT(*) * 100")
                + " AS share FROM trips"
                for a, _ in RAW_COLUMNS
                for b, _ in RAW_COLUMNS
            ),
            "trips",
        ),
        "etl_incremental": oracle("SELECT * FROM fact", "fact"),
        "prune_zone_day": oracle(
            "SELECT pickup_month, COUNT(*) AS row_count, COUNT(DISTINCT pickup_location_id) AS zones FROM fact WHERE pickup_month IN (2, 3) "
            "AND date_key BETWEEN DATE '1995-02-10' AND DATE '1996-03-20' AND pickup_location_id <= 5 GROUP BY pickup_month",
            "fact",
        ),
        "stable_ids": oracle(
            f"SELECT row_number() OVER (ORDER BY {', '.join(c.strip() + ' NULLS FIRST' for c in RAW_LIST.split(','))}) AS trip_number, "
            "tpep_dropoff_datetime, PULocationID, fare_amount, total_amount FROM trips",
            "trips",
        ),
        "rank_trips": oracle(
            "SELECT RANK() OVER (ORDER BY total_amount DESC NULLS LAST) AS total_rank, total_amount, PULocationID FROM trips", "trips"
        ),
        "publish_snapshot": oracle(
            "SELECT CAST(v AS INTEGER) AS version, table_name, CASE WHEN v = 2 AND table_name = 'fact_trips' "
            "THEN (SELECT COUNT(*) FROM fact WHERE NOT is_invalid_total) ELSE row_count END AS row_count, TRUE AS as_published "
            "FROM table_counts, (SELECT unnest([1, 2]) AS v)",
            "table_counts",
            "fact",
        ),
        "file_tree_digest": """SELECT s_suppkey, CAST(LENGTH(s_name) + 1 AS BIGINT) AS length, CAST(3 AS BIGINT) AS blocks,
  sha256(unhex(sha256(unhex(sha256(substr(text, 1, 8))) || unhex(sha256(substr(text, 9, 8)))))
      || unhex(sha256(unhex(sha256(substr(text, 17, 8)))))) AS tree_digest
FROM (SELECT *, s_name || chr(10) AS text FROM supplier)""",
        "file_encoding": """SELECT s_suppkey, ['utf-8', 'utf-16-le', 'utf-16-be', 'windows-1252', 'koi8-r', 'windows-1251',
    'ascii'][s_suppkey % 7 + 1] AS encoding, TRUE AS confident FROM supplier""",
        "file_md5": "SELECT s_suppkey, CAST(LENGTH(s_name) + 1 AS BIGINT) AS length, md5(s_name || chr(10)) AS md5 FROM supplier",
        "file_utf8": "SELECT s_suppkey, CAST(LENGTH(s_name) + 1 + (s_suppkey % 7 = 0)::INT AS BIGINT) AS length, "
        "CAST((s_suppkey % 7 = 0)::INT AS BIGINT) AS bad_lines, s_suppkey % 7 <> 0 AS is_utf8 FROM supplier",
        "q_median_approx": "SELECT unnest(['fare_median', 'distance_median', 'fare_low', 'fare_high']) AS statistic, "
        "TRUE AS within_error",
        "profile_sample": oracle(
            "SELECT CAST(s AS BIGINT) AS size, LEAST(n, s) AS sampled, LEAST(n, s) AS found_in_table FROM "
            "(SELECT COUNT(*) AS n FROM trips), (SELECT unnest([200000, 500]) AS s)",
            "trips",
        ),
        "q3_hourly_sql": oracle("SELECT * FROM q3", "q3"),
        "validate_wrong_count": oracle(
            "SELECT table_name, row_count + (table_name = 'fact_trips')::INT AS expected, row_count AS observed, "
            "table_name <> 'fact_trips' AS passed FROM table_counts",
            "table_counts",
        ),
        "validate_unreadable": oracle(
            "SELECT 'dim_time' AS table_name, 'readable' AS check_name, NULL::VARCHAR AS column_name, "
            "NULL::BIGINT AS observed, FALSE AS passed, TRUE AS has_error UNION ALL "
            "SELECT table_name, 'row_count', NULL, row_count, TRUE, FALSE FROM table_counts WHERE table_name <> 'dim_time' "
            "UNION ALL SELECT table_name, 'not_null', column_name, nulls, nulls = 0, FALSE FROM null_counts "
            "WHERE table_name <> 'dim_time'",
            "table_counts",
            "null_counts",
        ),
        "row_gate": oracle(
            "SELECT 'row_count' AS check_name, COUNT(*) AS observed, CAST(500000 AS BIGINT) AS required, "
            "COUNT(*) >= 500000 AS passed FROM trips",
            "trips",
        ),
        "clean_cast": oracle(
            "SELECT passenger_count, RatecodeID, trip_distance, fare_amount, tip_amount, total_amount, "
            "congestion_surcharge, airport_fee FROM std",
            "std",
        ),
        "clean_parse_ts": oracle(f"SELECT {ts} FROM trips", "trips"),
        "q_median": oracle(
            "SELECT fare_median, distance_median, fare_low, fare_high FROM medians, bounds", "medians", "bounds"
        ),
        "clean_neg_fare": oracle("SELECT PULocationID, DOLocationID, fare_amount FROM imputed", "imputed"),
        "clean_neg_tip": oracle(
            "SELECT PULocationID, CASE WHEN tip_amount < 0 THEN CAST(0 AS DOUBLE) ELSE tip_amount END AS tip_amount "
            "FROM std",
            "std",
        ),
        "flag_total": oracle("SELECT total_amount, total_amount <= 0 AS is_invalid_total FROM std", "std"),
        "clean_passengers": oracle(
            "SELECT PULocationID, CASE WHEN passenger_count IS NULL OR passenger_count = 0 THEN 1 "
            "WHEN passenger_count > 6 THEN 6 ELSE passenger_count END AS passenger_count FROM std",
            "std",
        ),
        "clean_zero_distance": oracle(
            "SELECT PULocationID, DOLocationID, CASE WHEN trip_distance = 0 THEN distance_median ELSE trip_distance END "
            "AS trip_distance FROM std, medians",
            "std",
            "medians",
        ),
        "clean_winsorise": oracle(
            "SELECT PULocationID, DOLocationID, LEAST(GREATEST(fare_amount, fare_low), fare_high) AS fare_amount "
            "FROM imputed, bounds",
            "imputed",
            "bounds",
        ),
        "derive_duration": oracle(
            f"SELECT {ts}, trip_duration_min, trip_duration_min <= 0 AS is_invalid_duration FROM std", "std"
        ),
        "drop_invalid": oracle(
            f"SELECT {ts}, trip_duration_min FROM std WHERE NOT (trip_duration_min <= 0)", "std"
        ),
        "derive_calendar": oracle(
            f"SELECT tpep_pickup_datetime, {HOUR} AS pickup_hour, {DOW} AS pickup_dow, {MONTH} AS pickup_month, "
            f"{DAY} AS pickup_date, {WEEK} AS pickup_week, {DOW} IN (1, 7) AS is_weekend FROM trips",
            "trips",
        ),
        "derive_time_of_day": oracle(
            f"SELECT tpep_pickup_datetime, {period(HOUR)} AS time_of_day FROM trips", "trips"
        ),
        "derive_airport": oracle(f"SELECT RatecodeID, airport_fee, {AIRPORT} AS is_airport_trip FROM std", "std"),
        "derive_tip_pct": oracle(f"SELECT fare_amount, tip_amount, {TIP_PCT} AS tip_pct FROM std", "std"),
        "derive_revenue": oracle(
            "SELECT fare_amount, extra, mta_tax, tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, "
            f"{REVENUE} AS revenue_excl_tip FROM std",
            "std",
        ),
        "derive_distance_bucket": oracle(
            f"SELECT trip_distance, {bucket('trip_distance')} AS distance_bucket FROM std", "std"
        ),
        "derive_labels": oracle(
            f"SELECT payment_type, RatecodeID, {payment_label('payment_type')} AS payment_label, "
            f"{rate_label('RatecodeID')} AS rate_label FROM std",
            "std",
        ),
        "surrogate_id": oracle("SELECT COUNT(*) AS row_count, COUNT(*) AS distinct_ids FROM fact", "fact"),
        "fact_trips": oracle("SELECT * FROM fact", "fact"),
        "dim_time": oracle("SELECT * FROM dim_time", "dim_time"),
        "dim_location": oracle("SELECT * FROM dim_location", "dim_location"),
        "dim_payment": oracle("SELECT * FROM dim_payment", "dim_payment"),
        "wh_roundtrip": oracle("SELECT * FROM table_counts", "table_counts"),
        "wh_partitioned": oracle(
            "SELECT pickup_month, COUNT(*) AS row_count FROM fact GROUP BY pickup_month", "fact"
        ),
        "etl_end_to_end": oracle(
            "SELECT lineage.*, (SELECT COUNT(*) FROM fact) AS fact_rows, "
            "kept_rows = (SELECT COUNT(*) FROM fact) AS rows_traced, verdict.* FROM lineage, verdict",
            "fact",
            "lineage",
            "verdict",
        ),
        "join_vendor": oracle(
            "SELECT fact.vendor_id, vendor_name, date_key, total_amount FROM fact LEFT JOIN dim_vendor "
            "ON fact.vendor_id = dim_vendor.vendor_id",
            "fact",
            "dim_vendor",
        ),
        "join_location_roles": oracle(
            "SELECT pickup_location_id, dropoff_location_id, p.location_type AS pickup_role, "
            "d.location_type AS dropoff_role, total_amount FROM fact "
            "JOIN dim_location p ON p.location_id = pickup_location_id AND p.location_type = 'pickup' "
            "JOIN dim_location d ON d.location_id = dropoff_location_id AND d.location_type = 'dropoff'",
            "fact",
            "dim_location",
        ),
        "q1_revenue_by_period": oracle("SELECT * FROM q1", "q1"),
        "q1_of_months": oracle(_revenue_by_period("pickup_month IN (6, 7, 8)"), "fact"),
        "q1_within_months": oracle(_revenue_by_period("TRUE", "pickup_month"), "fact"),
        "q4_of_months": oracle(_top_zones("pickup_month = 12"), "fact"),
        "q2_tip_by_distance": oracle("SELECT * FROM q2", "q2"),
        "q2_top_band": oracle("SELECT * FROM q2 WHERE top_tipping_rank_within_payment = 1", "q2"),
        "q3_hourly_demand": oracle("SELECT * FROM q3", "q3"),
        "q4_top_zones": oracle("SELECT * FROM q4", "q4"),
        "q5_airport_trend": oracle("SELECT * FROM q5", "q5"),
        "q5_iso_week": oracle("SELECT * FROM q5_weeks", "q5_weeks"),
        "vendor_revenue": oracle(
            f"SELECT vendor_name, {r('SUM(total_amount)')} AS total_revenue FROM fact LEFT JOIN dim_vendor "
            "ON fact.vendor_id = dim_vendor.vendor_id GROUP BY vendor_name",
            "fact",
            "dim_vendor",
        ),
        "preview": oracle(
            "SELECT * FROM q5 ORDER BY is_airport_trip DESC NULLS LAST, pickup_month, day_of_week LIMIT 20", "q5"
        ),
        "chart_hourly": oracle(
            f"SELECT pickup_hour, {bigint('SUM(trip_count) FILTER (WHERE NOT is_weekend)')} AS weekday_trips, "
            f"{bigint('SUM(trip_count) FILTER (WHERE is_weekend)')} AS weekend_trips FROM q3 GROUP BY pickup_hour",
            "q3",
        ),
        "chart_period": oracle(
            "SELECT revenue_rank, time_of_day, total_revenue / CAST(1000000 AS DOUBLE) AS revenue_millions, avg_fare "
            "FROM q1",
            "q1",
        ),
        "chart_tip_heatmap": oracle(
            "SELECT CAST(CASE distance_bucket WHEN '< 1 mi' THEN 1 WHEN '1–3 mi' THEN 2 WHEN '3–5 mi' THEN 3 "
            "WHEN '5–10 mi' THEN 4 ELSE 5 END AS INTEGER) AS bucket_order, distance_bucket, "
            "AVG(avg_tip_pct) FILTER (WHERE payment_label = 'Credit Card') AS credit_card, "
            "AVG(avg_tip_pct) FILTER (WHERE payment_label = 'Cash') AS cash FROM q2 GROUP BY distance_bucket",
            "q2",
        ),
        "chart_top10_zones": oracle(
            "SELECT pickup_location_id, avg_daily_revenue, revenue_rank FROM q4 "
            "ORDER BY revenue_rank, pickup_location_id LIMIT 10",
            "q4",
        ),
        "chart_payment_share": oracle(
            f"SELECT payment_label, {bigint('SUM(trip_count)')} AS trip_count, "
            f"{r('CAST(SUM(trip_count) AS DOUBLE) / SUM(SUM(trip_count)) OVER () * 100')} AS share_pct "
            "FROM q2 GROUP BY payment_label",
            "q2",
        ),
        "chart_airport_means": oracle(
            f"SELECT CASE WHEN is_airport_trip THEN 'Airport Trip' ELSE 'City Trip' END AS trip_kind, "
            f"{r('AVG(avg_fare)')} AS avg_fare, {r('AVG(avg_distance)')} AS avg_distance FROM q5 "
            "WHERE is_airport_trip IS NOT NULL GROUP BY 1",
            "q5",
        ),
        "chart_tip_period": oracle("SELECT revenue_rank, time_of_day, avg_tip_pct FROM q1", "q1"),
        "chart_rank_scatter": oracle(
            "SELECT pickup_location_id, revenue_rank, total_revenue / CAST(1000 AS DOUBLE) AS revenue_thousands, "
            "active_days * 3 AS mark_size FROM q4 ORDER BY revenue_rank, pickup_location_id LIMIT 10",
            "q4",
        ),
        "validate_counts": oracle(
            "SELECT table_name, row_count AS expected, row_count AS observed, TRUE AS passed FROM table_counts",
            "table_counts",
        ),
        "validate_nulls": oracle(
            "SELECT table_name, column_name, nulls, 'warn' AS severity, nulls = 0 AS passed FROM null_counts",
            "null_counts",
        ),
        "validate_all": oracle("SELECT * FROM verdict", "verdict"),
        # the number of files differs per run: at least one
        "ingest_gate": oracle(f"{_GATE} UNION ALL SELECT 'unreadable', 0, 0, TRUE", "trips"),
        "ingest_gate_csv": oracle(f"{_GATE} UNION ALL SELECT 'unreadable', 1, 0, FALSE", "trips"),
        "row_lineage": oracle("SELECT * FROM lineage", "lineage"),
        "dq_findings": oracle(_finding_rows, "std"),
        "cleaning_strategy": oracle(_strategy_rows, "std", "clean", "medians", "bounds"),
        "profile_missing": oracle(_missing_rows, "trips"),
        "profile_stats": oracle(
            f"SELECT column_name, COUNT(*) AS n, {r('AVG(v)')} AS mean, "
            f"{r('percentile_disc(0.5) WITHIN GROUP (ORDER BY v)')} AS median, {r('STDDEV_SAMP(v)')} AS std, "
            f"{r('MIN(v)')} AS min, {r('MAX(v)')} AS max FROM values_of GROUP BY column_name",
            "values_of",
        ),
        "profile_histogram": oracle(
            f"SELECT column_name, bin, {r('low + (high - low) / 20 * (bin - 1)', 6)} AS low_edge, "
            f"{r('low + (high - low) / 20 * bin', 6)} AS high_edge, n FROM bins20 JOIN value_ranges USING (column_name)",
            "bins20",
            "value_ranges",
        ),
        "profile_kde": oracle(
            f"SELECT column_name, {integer('point')} AS point, {r('low + width * (point - 0.5)', 6)} AS x, "
            f"{r('SUM(n * EXP(-0.5 * POWER(width * (point - bin) / h, 2))) / (MAX(total) * MAX(h) * SQRT(2 * PI()))', 6)} "
            "AS density FROM bandwidth JOIN bins64 USING (column_name), range(1, 65) AS g(point) "
            "WHERE h > 0 GROUP BY column_name, point, low, width",
            "bandwidth",
            "bins64",
        ),
        "profile_duplicates": oracle(
            "SELECT CAST(SUM(c) AS BIGINT) AS total_rows, COUNT(*) AS distinct_rows, "
            "COUNT(*) FILTER (WHERE c > 1) AS duplicate_groups, CAST(SUM(c - 1) AS BIGINT) AS surplus_rows "
            f"FROM (SELECT COUNT(*) AS c FROM trips GROUP BY {RAW_LIST})",
            "trips",
        ),
        "profile_outliers": oracle(
            f"SELECT column_name, {r('q1', 6)} AS q1, {r('q3', 6)} AS q3, {r(low_fence, 6)} AS lower_fence, "
            f"{r(high_fence, 6)} AS upper_fence, COUNT(*) FILTER (WHERE v < {low_fence}) AS below, "
            f"COUNT(*) FILTER (WHERE v > {high_fence}) AS above, "
            f"{r(f'CAST(COUNT(*) FILTER (WHERE v < {low_fence} OR v > {high_fence}) AS DOUBLE) / COUNT(*) * 100')} "
            "AS outlier_pct FROM values_of JOIN spread USING (column_name) GROUP BY column_name, q1, q3",
            "values_of",
            "spread",
        ),
        "profile_missing_matrix": oracle(_matrix_rows, "trips"),
    }
