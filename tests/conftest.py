import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tripmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripmart-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make(spark):
    """Build a raw-trip frame from a few set columns; the others are null."""
    from tripmart import schemas as S

    def build(rows: list[dict], schema=S.RAW_TRIPS):
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df) -> int:
    """How often the executed plan reads files; a reused exchange reads nothing."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0].count("FileScan")
