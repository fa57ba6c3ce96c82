"""Every query against its SQL on the same files: names, types and values (as bags) must be equal."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _bag(rows, order):
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    check(spark, duck, sf_dir, name)


@pytest.mark.parametrize("name", ["clean_parse_ts", "csv_roundtrip", "derive_calendar", "derive_duration", "dim_time"])
def test_matches_sql_in_a_zone_with_daylight_saving(spark, duck, sf_dir, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check(spark, duck, sf_dir, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def check(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    ours = df.collect()
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    types = [str(c[1]) for c in result.description]
    theirs = result.fetchall()

    our_order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    their_order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert [df.columns[i] for i in our_order] == [columns[i] for i in their_order]
    our_types = [TYPES[df.schema.fields[i].dataType.simpleString()] for i in our_order]
    assert our_types == [types[i] for i in their_order]
    assert len(ours) == len(theirs)
    assert _bag(ours, our_order) == _bag(theirs, their_order)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "time_of_day"
    assert df.count() == 5
