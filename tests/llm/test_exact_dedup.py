import hashlib
import re

from tests.llm.conftest import ROWS
from tripmart.llm import exact_dedup
from tripmart.llm.exact_dedup import DigestIndex, digests
from tripmart.workspace import new_path


def index(spark, name):
    return DigestIndex(spark, name, new_path(spark, name), buckets=4)


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_longest_then_smallest_stays(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "ab"), (4, "a \tb"), (5, "c"), (6, "ab ")], "doc_id int, text string")
    rows = {r.id: r for r in index(spark, "ix_longest").append(digests(docs), "1").collect()}
    assert [(rows[i].keep_id, rows[i].group_size, rows[i].kept) for i in range(1, 7)] == [
        (2, 4, False), (2, 4, True), (2, 4, False), (2, 4, False), (5, 1, True), (6, 1, True)
    ]
    assert rows[1].digest == hashlib.sha256(b"ab").digest()


def test_a_later_batch_meets_the_index(spark):
    ix = index(spark, "ix_later")
    first = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id int, text string")
    second = spark.createDataFrame([(3, " x"), (4, "z"), (5, "z")], "doc_id int, text string")
    ix.append(digests(first), "1").collect()
    rows = {r.id: (r.keep_id, r.kept) for r in ix.append(digests(second), "2").collect()}
    assert rows == {3: (1, False), 4: (4, True), 5: (4, False)}
    assert ix.rows().count() == 3
    reopened = DigestIndex(spark, "ix_later", ix.location, buckets=4)
    assert reopened.rows().count() == 3


def test_index_is_not_shuffled(spark):
    ix = index(spark, "ix_plan")
    ix.append(digests(spark.createDataFrame([(1, "x")], "doc_id int, text string")), "1").collect()
    new = spark.createDataFrame([(b"1",)], "digest binary").repartition(4, "digest")
    plan = new.join(ix.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def docs_of(spark, *rows):
    return digests(spark.createDataFrame(list(rows), "doc_id int, text string"))


def test_an_append_may_be_repeated(spark):
    ix = index(spark, "ix_retry")
    ix.append(docs_of(spark, (1, "x"), (2, "y")), "1").collect()
    batch = docs_of(spark, (3, "x"), (4, "z"), (5, "z "), (6, "w"))
    once = {tuple(r) for r in ix.append(batch, "2").collect()}
    assert {tuple(r) for r in ix.append(batch, "2").collect()} == once
    assert {r[0] for r in once if r[4]} == {5, 6} and ix.rows().count() == 4


def test_an_append_that_died_half_way_is_completed(spark):
    ix = index(spark, "ix_died")
    batch = docs_of(spark, (4, "z"), (5, "z "), (6, "w"))
    ix.append(batch.where("id < 6"), "1")  # some buckets only
    rows = {r.id: (r.keep_id, r.kept) for r in ix.append(batch, "1").collect()}
    assert rows == {4: (5, False), 5: (5, True), 6: (6, True)}


def test_batches_together_decide_as_one_after_the_other(spark):
    ix = index(spark, "ix_each")
    rows = ix.append_each({"1": docs_of(spark, (9, "a  a"), (8, "b")), "2": docs_of(spark, (1, "a a"), (2, "c"), (3, "c"))}).collect()
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in rows} == {
        (9, 9, 2, True), (1, 9, 2, False), (8, 8, 1, True), (2, 2, 2, True), (3, 2, 2, False)
    }


def test_compaction_leaves_one_sorted_file_to_a_bucket(spark):
    ix = index(spark, "ix_compact")
    for n in range(3):
        ix.append(docs_of(spark, *[(i, f"text {i % 60}") for i in range(40 * n, 40 * n + 40)]), str(n)).collect()
    before = {tuple(r) for r in ix.rows().collect()}
    assert len(before) == 60 and len(ix.rows().inputFiles()) > 4
    ix.compact()
    assert {tuple(r) for r in ix.rows().collect()} == before and len(ix.rows().inputFiles()) == 4
    with ix._sorted_scans():
        new = spark.createDataFrame([(b"1",)], "digest binary").repartition(4, "digest")
        plan = new.join(ix.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1  # the new rows' own
    ix.compact(buckets=2)
    reopened = DigestIndex(spark, "ix_compact", ix.location)
    assert reopened.buckets == 2 and {tuple(r) for r in reopened.rows().collect()} == before
    assert not {r.id for r in reopened.append(docs_of(spark, (500, "text 1")), "9").collect() if r.kept}


def test_many_files_are_compacted_before_the_next_batch(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILES_PER_BUCKET", 1)
    ix = index(spark, "ix_auto")
    for n in range(4):
        ix.append(docs_of(spark, *[(i, f"t{i}") for i in range(20 * n, 20 * n + 20)]), str(n)).collect()
    assert ix.version[0] > 1 and ix.rows().count() == 80


def test_tricky(spark, tricky, nothing):
    rows = index(spark, "ix_tricky").append(digests(tricky), "1").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        same = [i for i, t, *_ in ROWS if hashlib.sha256(bare(t).encode()).digest() == r.digest]
        assert r.group_size == len(same) and r.keep_id in same
    empties = {r.keep_id for r in rows if r.digest == hashlib.sha256(b"").digest()}
    assert empties == {9}  # the most code points
    assert index(spark, "ix_none").append(digests(nothing), "1").count() == 0
