"""Where jobs may write: the shared folder the session names in ``spark.checkpoint.dir``, else its warehouse folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_roots: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """A folder that the driver and every executor reach. The setting is read from the session, never written."""
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def session_root(spark: SparkSession) -> str:
    """This application's folder below the shared one. Spark's file system removes it when the application ends, so
    intermediate tables of past runs do not pile up."""
    root = f"{shared_root(spark)}/tripmart/{spark.sparkContext.applicationId}"
    if root not in _roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _roots.add(root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's folder; two calls never share one."""
    return f"{session_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, and a lost executor costs no rerun of
    what came before."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file, through Spark's own file systems, so that any shared folder will do."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
