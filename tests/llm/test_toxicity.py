import random

import numpy as np
import pytest

from tests.llm.conftest import ROWS
from tripmart.llm import toxicity

DATA = "/root/testdata/sf0.1"


def heaviest(text):
    return toxicity.seed_grammar().features(text)[0]


def paths(classes):
    """Every path through the five transducers one after the other, spelled out: the heaviest score of each clause."""
    machines = [toxicity.REPORTED, toxicity.NEGATED, toxicity.AIMED, toxicity.INSULTS, toxicity.THREATS]
    out, states = [], [((0,) * 5, 0.0)]
    for symbol, weight in (*classes, (toxicity.BREAK, 0.0)):
        after = []
        for state, held in states:
            partial = [((), symbol, 1.0)]
            for machine, at in zip(machines, state, strict=True):
                partial = [((*done, into), output, f * factor) for done, s, f in partial for output, factor, into in machine.arcs[at][s]]
            after += [(done, held + weight * f) for done, _, f in partial]
        states = after
        if symbol == toxicity.BREAK:
            out.append(max(score for _, score in states))
            states = [(state, 0.0) for state in {state for state, _ in states}]
    return [x for x in out if x]


def test_composition_is_the_enumeration_of_all_paths():
    draw = random.Random(11)
    grammar = toxicity.seed_grammar()
    words = "idiot kill you not said very table . \" but moron he".split()
    for _ in range(400):
        text = " ".join(draw.choices(words, k=draw.randrange(1, 9)))
        assert grammar.clauses(text) == pytest.approx(paths([c or (toxicity.PLAIN, 0.0) for c in grammar.classes(text)])), text


def test_compose_multiplies_factors_and_reaches_pairs():
    one = toxicity.transducer(2, (0, [toxicity.PLAIN], 1, 2.0, toxicity.TARGET), (1, [toxicity.PLAIN], 0))
    two = toxicity.transducer(1, (0, [toxicity.TARGET], 0, 3.0))
    both = toxicity.compose(one, two)
    assert len(both.arcs) == 2
    assert both.arcs[0][toxicity.PLAIN] == ((toxicity.TARGET, 6.0, 1),) and both.arcs[1][toxicity.PLAIN] == ((toxicity.PLAIN, 1.0, 0),)


def test_clauses():
    weight, f = toxicity.SEED_WEIGHT, toxicity.FACTORS
    assert heaviest("an idiot.") == pytest.approx(weight * f["bare"])
    assert heaviest("you are an idiot.") == heaviest("idiot that you are") == pytest.approx(weight * f["aimed"])
    assert heaviest("not really an idiot") == pytest.approx(weight * f["bare"] * f["negated"])
    assert heaviest("not today, idiot") == pytest.approx(weight * f["bare"])  # a plain word ends the negation
    assert heaviest('Anna said "idiot"') == pytest.approx(weight * f["bare"] * f["reported"])
    assert heaviest('"idiot"') == pytest.approx(weight * f["bare"])
    assert heaviest("you. idiot") == pytest.approx(weight * f["bare"])  # the target is in another clause
    assert heaviest("you idiot, I will kill you") == pytest.approx(2 * weight * f["aimed"])
    assert heaviest("kill the process") == pytest.approx(weight * f["bare threat"])
    assert heaviest("kein idiot aber ein crétin") == pytest.approx(weight * f["bare"])
    assert heaviest("a table and a chair") == 0
    assert toxicity.seed_grammar().features("idiot. moron! stupid?")[2] == 3


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    known = docs.join(labels, "doc_id")
    return known, toxicity.learn(known.where("crc32(string(doc_id)) % 3 <> 1"))


def test_harmless_sentences(learned):
    _, grammar = learned
    for text in ("The path is long.", "Das Wort Pfad.", "I lose my keys.", "kill the process", "a clownfish and a scummer"):
        assert grammar.score(*grammar.features(text)) < 0.5, text
    for text in ("worthless.", "It is not worthless", "she said \"idiot\""):
        assert grammar.score(*grammar.features(text)) < 0.7, text
    assert grammar.score(*grammar.features("you are an idiot.")) > 0.7


def test_whole_table_held_out(learned):
    known, grammar = learned
    rows = toxicity.score(known.where("crc32(string(doc_id)) % 3 = 1"), grammar).collect()
    toxic, clean = np.array([r.score for r in rows if r.toxic]), np.array([r.score for r in rows if not r.toxic])
    auc = ((toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2)
    print("auc", auc, "recall", (toxic >= 0.7).mean(), "false", (clean >= 0.7).mean())
    assert auc >= 0.95 and (toxic >= 0.7).mean() > 0.8 and (clean >= 0.7).mean() < 0.03


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").where("doc_id < 4000")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    known = docs.join(labels, "doc_id")
    grammar = toxicity.learn(known.where("crc32(string(doc_id)) % 3 <> 1"))
    rows = toxicity.score(known.where("crc32(string(doc_id)) % 3 = 1"), grammar).collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([[(t > c) + (t == c) / 2 for c in clean] for t in toxic]) > 0.85
    assert np.mean([t >= 0.7 for t in toxic]) > 0.7 and np.mean([c >= 0.7 for c in clean]) < 0.03


def test_labels_are_sampled_within_the_bound(spark):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    n = {r.toxic: r["count"] for r in toxicity.sample_labels(labels, sample=500).groupBy("toxic").count().collect()}
    assert all(350 < x < 650 for x in n.values()) and set(n) == {0, 1}


def test_tricky(tricky, nothing):
    grammar = toxicity.learn(nothing.selectExpr("text", "1 AS toxic"))
    assert not grammar.stems
    out = toxicity.score(tricky, grammar)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows}) == 1  # nothing here matches
    assert set(out.columns) == (set(tricky.columns) - {"text"}) | {"score", "matched_clauses", "heaviest", "total"}
    assert toxicity.score(nothing, grammar).count() == 0
    assert not toxicity.learn(tricky.selectExpr("text", "1 AS toxic")).stems  # one label only


def test_texts_of_one_sketch_stay_under_both_labels(spark, monkeypatch):
    """A clean text and its toxic edit share a sketch; neither goes, and the order of the rows decides nothing."""
    monkeypatch.setattr(toxicity, "_sketch", lambda tokens: 1)
    kept = []
    write = toxicity.materialise
    monkeypatch.setattr(toxicity, "materialise", lambda df, name: [kept.append(out := write(df, name)) if name == "labelled" else (out := write(df, name)), out][1])
    rows = [("a b c d clean", 0), ("a b c d toxic", 1), ("a b c d also clean", 0), ("a b c d too", 1)]
    for order in (rows, rows[::-1]):
        toxicity.learn(spark.createDataFrame(order, "text string, toxic int").coalesce(1))
    first, again = ({(r.text, r.label) for r in df.collect()} for df in kept)
    assert first == again and {label for _, label in first} == {0, 1}
