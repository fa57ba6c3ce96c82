import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_line_dedup import brute as without_repeats
from tests.llm.test_simhash import brute_components, brute_print
from tripmart.llm import catalog, curriculum


@pytest.fixture(scope="module")
def steps(spark, docs, sf_dir):
    """Input and output of every stage, as ``run`` chains them."""
    found, extra = [], spark.createDataFrame([(9001, "1234 ... 5678", "en", "src0", 13), (9002, None, "en", "src0", 0)], docs.schema)
    rows = docs.union(extra)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf_dir).cache()
        found.append((name, rows.collect(), out.collect(), out.columns))
        rows = out
    return found


def test_columns(docs, steps):
    assert all(columns == docs.columns for *_, columns in steps[:-1])


def test_each_stage_takes_effect(steps):
    (_, before, after, _), (_, _, shortened, _), (_, _, apart, _), (_, _, mixed, _), (_, _, spelled, _) = steps
    ids = lambda rows: {r.doc_id for r in rows}
    assert ids(before) - ids(after) == {9001, 9002}
    expected = {i: t for i, t in without_repeats([(r.doc_id, r.text) for r in after]).items() if t.strip() or not dict((r.doc_id, r.text) for r in after)[i].strip()}
    assert {r.doc_id: r.text for r in shortened} == expected
    assert all(r.n_chars == len(r.text) for r in shortened)
    prints = {r.doc_id: brute_print(r.text) for r in shortened}
    close = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert sorted(r.doc_id for r in apart) == sorted(set(brute_components(close, prints).values()))
    assert len(apart) < len(shortened)
    assert ids(mixed) <= ids(apart) and len(mixed) > len(ids(mixed))
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(size(mixed) - curriculum.SHARE * size(apart)) < 0.2 * size(apart)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in mixed}
    assert len(spelled) == len(mixed)
    for r in spelled[:100]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_one_python_worker_a_task(spark, docs, sf_dir):
    """Encoding and decoding in workers of their own took an executor above its memory."""
    for out in (corpus_pipeline.tokens(spark, docs, sf_dir), catalog.QUERIES["op3_bpe_lexicon"](spark, sf_dir)):
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(rows.columns)


def test_no_rows(docs, spark, sf_dir):
    rows = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, sf_dir)
        assert rows.count() == 0


def test_clashing_columns_stay(docs, spark, sf_dir):
    names = ["lines_removed", "lang_share", "score", "lang_pred", "training_position", "_hash", "_a", "row", "id", "ids"]
    rows = docs.where("doc_id < 60").select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf_dir)
        assert rows.columns == [*docs.columns, *names], name
    assert all(r[n] == f"own {n}" for r in rows.collect() for n in names)
