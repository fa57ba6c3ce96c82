"""Landing job: write a batch into the raw zone, list what arrived, judge it."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tripmart import schemas as S
from tripmart.operators.checks import ingest_gate
from tripmart.operators.cleaning import standardise, statistics_state
from tripmart.operators.quantiles import merged_counts
from tripmart.sources.files import file_gate, file_utf8, list_files
from tripmart.sources.sinks import land_batch
from tripmart.sources.tables import conform_trips, scan_trips

_FILES = "path string, length bigint, modified_at timestamp"
_ENCODINGS = "path string, length bigint, bad_lines bigint, is_utf8 boolean"
_ROWS = "format string, n bigint, readable boolean"


def landed_path(zone: str, year: int, month: int) -> str:
    return f"{zone}/year={year}/month={month}"


def _row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per format, counted at once: what cannot be read counts as none and is told apart. Parquet is counted from its
    footers, CSV by its records after the header."""
    reader = spark.read.option("recursiveFileLookup", True)
    formats = {
        "parquet": lambda: reader.option("pathGlobFilter", "*.parquet").schema(S.RAW_TRIPS).parquet(path),
        "csv": lambda: reader.option("pathGlobFilter", "*.csv").option("header", True).schema("first string").csv(path),
    }
    rows = []
    for name, load in formats.items():
        try:
            rows.append((name, load().count(), True))
        except (PySparkException, Py4JJavaError):
            rows.append((name, 0, False))
    return spark.createDataFrame(rows, _ROWS)


def landing_gate(
    spark: SparkSession,
    path: str,
    min_rows: int = S.MIN_ROWS,
    min_bytes: int = S.MIN_FILE_BYTES,
    extensions: tuple[str, ...] = S.ALLOWED_EXTENSIONS,
) -> DataFrame:
    """Verdict rows for a folder of Parquet and CSV files: presence, extensions, sizes, readability, number of rows,
    encoding of text. A folder that is missing, empty or unreadable fails checks; it raises nothing."""
    try:
        listing = list_files(spark, path, "[!_.]*")
        encodings = file_utf8(spark, path)
    except (FileNotFoundError, PySparkException):  # no such folder
        listing, encodings = spark.createDataFrame([], _FILES), spark.createDataFrame([], _ENCODINGS)
    return ingest_gate(file_gate(listing, extensions, min_bytes), _row_counts(spark, path), min_rows, encodings)


def state_path(zone: str) -> str:
    """Beside the raw zone, not in it: scans of the zone do not meet the states."""
    return f"{zone.rstrip('/')}-states"


def land_trips(df: DataFrame, zone: str, year: int, month: int) -> DataFrame:
    """Bring a batch to the raw schema, replace that of its load date, and read it back from where it landed."""
    land_batch(conform_trips(df), zone, year, month)
    return scan_trips(df.sparkSession, landed_path(zone, year, month))


def keep_state(spark: SparkSession, zone: str, year: int, month: int) -> None:
    """Write what a landed batch contributes to the statistics of the zone; replaces the batch's earlier state."""
    state = statistics_state(standardise(scan_trips(spark, landed_path(zone, year, month))))
    state.write.mode("overwrite").parquet(landed_path(state_path(zone), year, month))


def zone_state(spark: SparkSession, *states: str) -> DataFrame:
    """The states of batches, merged: coarse counts of all trips of the zone."""
    return merged_counts(spark.read.parquet(*states).drop("year", "month"))
