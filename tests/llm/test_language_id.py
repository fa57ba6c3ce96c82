import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS, peak_bytes
from tripmart.llm import language_id


@pytest.fixture(scope="module")
def model(docs):
    return language_id.learn(docs.where("doc_id % 4 <> 2"))


def test_held_out_accuracy(docs, model):
    held = docs.where("doc_id % 4 = 2")
    rows = language_id.identify(held, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 and 0 <= r.lang_share <= 1 for r in rows)


def test_filter_returns_all_languages_of_a_gram():
    draw = np.random.default_rng(1)
    grams = {name: draw.integers(0, 2**63, 20_000).astype(np.uint64) for name in "abc"}
    grams["d"] = np.concatenate([grams["a"][:5_000], grams["b"][:5_000]])
    known = language_id.LanguageFilter.of(grams)
    for name, bit in zip(known.languages, range(4), strict=True):
        assert ((known.masks(grams[name])[0] >> bit) & 1).all()
    strangers = draw.integers(0, 2**63, 200_000).astype(np.uint64)
    seen = [float(((known.masks(strangers)[0] >> b) & 1).mean()) for b in range(4)]
    assert seen == pytest.approx(known.false_rates().tolist(), abs=2e-4)


def test_ngrams_stay_within_words_and_texts():
    one, bounds, _ = language_id.ngrams(["ab cd"])
    parts = [language_id.ngrams([w])[0] for w in ("ab", "cd")]
    assert sorted(one) == sorted(np.concatenate(parts))
    both, bounds, letters = language_id.ngrams(["Hallo Welt", None, "", "12 ..", "Ünï"])
    for i, text in enumerate(["Hallo Welt", None, "", "12 ..", "Ünï"]):
        own = np.concatenate([both[a:b] for a, b in bounds[i]])
        assert sorted(own) == sorted(language_id.ngrams([text])[0])
    assert letters.tolist() == [True, False, False, False, True]


def test_the_language_of_a_score_is_not_an_input(spark, docs, model):
    held = docs.where("doc_id % 4 = 2")
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(held, model).collect()}
    other = held.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
    assert plain == {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(other, model).collect()}


def test_tricky(spark, tricky, nothing, model):
    out = language_id.identify(tricky, model)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(ROWS)
    assert [(rows[i].lang_pred, rows[i].score) for i in (2, 3, 9)] == [("und", 0.0)] * 3
    assert rows[7].lang_pred == rows[8].lang_pred != "und"
    assert set(out.columns) == (set(tricky.columns) - {"text"}) | {"lang_pred", "score", "lang_share"}
    assert language_id.identify(nothing, model).count() == 0
    few = language_id.learn(tricky)
    assert few.languages == ("de", "fr")
    single = spark.createDataFrame([(1, "q"), (2, "漢字")], "doc_id int, text string")
    assert all(r.lang_pred in ("de", "fr") and 0 <= r.score <= 1 for r in language_id.identify(single, few).collect())


def test_without_labels_nothing_is_told_apart(docs, nothing):
    model = language_id.learn(nothing)
    assert {(r.lang_pred, r.score, r.lang_share) for r in language_id.identify(docs, model).collect()} == {("und", 0.0, 0.0)}
    assert language_id.identify(nothing, model).count() == 0


def test_seventy_languages(spark):
    draw = np.random.default_rng(3)
    words = {f"l{i:02}": ["".join(draw.choice(list("abcdefghijklmnop"), 6)) for _ in range(40)] for i in range(70)}
    rows = [(" ".join(draw.choice(own, 30)), lang) for lang, own in words.items() for _ in range(6)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = language_id.learn(docs)
    assert len(model.languages) == 70 and model.cells.shape[0] == 2
    found = language_id.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in found)


def test_copies_of_a_text_do_not_crowd_out_the_others(spark):
    """One text given 20,000 times, and 40 others: all of them are learned, and the copies once."""
    other = [("".join(chr(0x3B1 + (7 * i + k * k) % 24) for k in range(60)), "el") for i in range(40)]
    rows = spark.createDataFrame(other * 2, "text string, lang string").union(
        spark.range(20_000).selectExpr("'spread the same line again' AS text", "'el' AS lang")
    )
    model = language_id.learn(rows.union(spark.createDataFrame([("hello you there", "en")], rows.schema)), sample=1000)
    el = model.languages.index("el")
    known = [model.masks(language_id.ngrams([t])[0])[0] >> np.uint8(el) & 1 for t, _ in other]
    assert np.mean(np.concatenate(known)) > 0.8


@pytest.mark.parametrize("block", [1, 5, 64])
def test_blocks_give_the_shares_of_the_whole(docs, model, block):
    texts = [r.text for r in docs.select("text").limit(12).collect()]
    texts += [None, "", "12 ..", "Ünï ΑΣ.Α ΟΔΟΣ", "abcdefgh" * 20, "漢字" * 50, " . 7 " * 20]
    whole, letters = model.shares(texts, block=1 << 30)
    parts, same = model.shares(texts, block=block)
    assert (whole == parts).all() and (letters == same).all()


def test_a_very_long_text_takes_little_memory(model):
    """20 MB, also without a border in it."""
    for text in ("die Wege gehen weiter und weiter über Land " * 460_000, "x" * 20_000_000):
        assert peak_bytes(lambda text=text: model.shares([text])) < 320 << 20
