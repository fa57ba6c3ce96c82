"""Files written by tasks: one per path, complete, and without work per file on the driver."""

import os

from tripmart.catalog import stage
from tripmart.catalog.queries import QUERIES
from tripmart.sources import files, sinks
from tripmart.workspace import new_path


def test_lines_of_a_path_are_one_file(spark):
    rows = [("a/x.txt", b"2"), ("b/y.csv", b""), ("a/x.txt", b"1"), *[(f"c/{i}.txt", b"\xff") for i in range(40)]]
    base = new_path(spark, "files")
    assert sinks.write_files(spark.createDataFrame(rows, "path string, line binary").repartition(5), base) == 42
    assert open(f"{base}/a/x.txt", "rb").read() == b"1\n2\n" and open(f"{base}/b/y.csv", "rb").read() == b"\n"
    assert sorted(os.listdir(f"{base}/a")) == ["x.txt"] and len(os.listdir(f"{base}/c")) == 40


def test_no_lines_leave_an_empty_folder(spark):
    base = new_path(spark, "files")
    assert sinks.write_files(spark.createDataFrame([], "path string, line binary"), base) == 0
    assert files.list_files(spark, base).count() == 0


def test_supplier_files_are_not_committed_one_by_one(spark, tmp_path, monkeypatch):
    """Repeated keys share a file; a null name is an empty line of text and no line of CSV; no partitioned write, whose commit costs the driver a step per file."""
    from pyspark.sql.readwriter import DataFrameWriter

    rows = [(2, "b"), (2, "a, c"), (3, None), (4, None), (7, "x"), (1007, "y")]
    spark.createDataFrame(rows, "s_suppkey bigint, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(DataFrameWriter, "partitionBy", None)
    lengths = {r.s_suppkey: r.length for r in QUERIES["landing_listing"](spark, str(tmp_path)).collect()}
    assert lengths == {2: 9, 3: 1, 4: 0, 7: 2, 1007: 2}
    bad = {r.s_suppkey: r.bad_lines for r in QUERIES["file_utf8"](spark, str(tmp_path)).collect()}
    assert bad == {2: 0, 3: 0, 4: 0, 7: 1, 1007: 0}
    assert set(os.listdir(stage.supplier_files(spark, str(tmp_path), "plain"))) == {"group=0", "group=1"}


def test_no_folder_for_a_single_supplier(spark, tmp_path):
    """A folder to a file is one more thing to make, to list and to delete for every supplier."""
    spark.createDataFrame([(i, f"name {i}") for i in range(30)], "s_suppkey bigint, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    for name, kind in (("file_gate", "plain"), ("file_md5", "plain"), ("file_tree_digest", "plain"), ("file_utf8", "marked"), ("file_encoding", "encoded")):
        folder = stage.supplier_files(spark, str(tmp_path), kind)
        assert len([f for f in os.listdir(f"{folder}/group=0") if os.path.isfile(f"{folder}/group=0/{f}")]) == 30
        if kind != "encoded":
            assert sorted(r.s_suppkey for r in QUERIES[name](spark, str(tmp_path)).collect()) == list(range(30))
