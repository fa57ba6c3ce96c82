from collections import defaultdict

import pytest

from tests.llm.conftest import ROWS
from tripmart.llm import catalog, curriculum


def water(sizes, weights, share, repeat):
    """Targets by sharing the excess again and again."""
    total, targets, full = share * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(repeat * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        targets = {s: repeat * sizes[s] if s in full else rest * weights[s] / sum(weights[t] for t in open_) for s in sizes}
        over = [s for s in open_ if targets[s] > repeat * sizes[s]]
        if not over:
            return targets
        full |= set(over)


def test_targets_and_taken(spark, docs):
    rows = curriculum.plan(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(sizes))}
    targets = water(sizes, weights, 1.5, 2)
    largest = max(r.size for r in rows)
    for r in rows:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - targets[s]) <= largest / 2 for s in sizes)
    again = {r.id: r for r in curriculum.plan(docs.repartition(7)).collect()}
    assert all(again[r.id] == r for r in rows)


def test_positions_follow_the_schedule(spark):
    """A weight that falls from 1.5 to 0.5 puts 62.5 % of the words in the first half, one that rises 37.5 %."""
    df = spark.range(4_000).selectExpr("id AS doc_id", "'w w w' AS text", "CASE WHEN id < 2000 THEN 'a' ELSE 'b' END AS source")
    shapes = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)))
    early = defaultdict(list)
    for r in curriculum.plan(df, weights=(1.0,), shapes=shapes, share=1.0).collect():
        early[r.source] += [p < 0.5 for p in r.positions]
    assert sum(early["a"]) / len(early["a"]) == pytest.approx(0.625, abs=0.01)
    assert sum(early["b"]) / len(early["b"]) == pytest.approx(0.375, abs=0.01)


def test_arranged_is_sorted_and_holds_every_copy(docs):
    mixed = curriculum.arranged(docs)
    rows = [r.training_position for r in mixed.select("training_position").collect()]
    assert rows == sorted(rows)
    wanted = {r.id: r.copies for r in curriculum.plan(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == wanted
    assert mixed.columns[: len(docs.columns)] == docs.columns


def test_tricky(tricky, nothing):
    rows = curriculum.plan(tricky).collect()
    assert len(rows) == len(ROWS)
    assert {r.source for r in rows} == {"s0", "s1", None}
    assert all(r.target == 0 and r.taken == 0 for r in rows if r.source is None)
    out = curriculum.arranged(tricky)
    assert out.count() > 0 and out.columns.count("training_position") == 1
    assert curriculum.plan(nothing).count() == 0 and curriculum.arranged(nothing).count() == 0


def test_documents_without_id_keep_to_the_target(spark):
    """Null ids, one size, some rows repeated: as many copies as planned, each in its own place."""
    rows = [(None, f"one two three n{i % 180}", "s") for i in range(200)]
    rows += [(i, f"a b c {i}", s) for i, s in enumerate("tuv" * 100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned = {r.source: r.copies for r in curriculum.plan(docs).groupBy("source").agg({"copies": "sum"}).toDF("source", "copies").collect()}
    mixed = curriculum.arranged(docs).collect()
    found = [r for r in mixed if r.source == "s"]
    assert planned["s"] == len(found) < 2 * 200
    assert len({r.training_position for r in found}) == len(found)


def test_query_counts_what_the_mix_holds(spark, tmp_path, monkeypatch):
    """The schedule decides where a copy stands: of half the training time, the query shows half the words. Null and repeated ids, repeated
    rows and null sources are in the mix as planned."""
    rows = [(i if i % 7 else None, f"w {i % 5 * 'w '}n{i}", "abc"[i % 3]) for i in range(600)]
    rows += [(i, "x y z", None) for i in range(40)] * 2 + [(5000, "a b c", "a")] * 9 + [(5000, "d e f", "a")] * 8 + [(5001, None, "b")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["size", "source_size", "target", "taken", "copies"]
    bag = lambda df: sorted(df.collect(), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    wanted = bag(curriculum.plan(docs).select("id", *columns))
    whole = bag(catalog.op10_curriculum_mix(spark, str(tmp_path)).select("doc_id", *columns))
    assert [tuple(r) for r in whole] == [tuple(r) for r in wanted] and len({r.copies for r in whole}) > 1
    arranged = curriculum.arranged
    monkeypatch.setattr(curriculum, "arranged", lambda *a, **k: arranged(*a, **k).where("training_position < 0.5"))
    half = bag(catalog.op10_curriculum_mix(spark, str(tmp_path)))
    assert len(half) == len(whole) and 0.3 < sum(r.taken for r in half) / sum(r.taken for r in whole) < 0.8
