"""License scans against a comparison of every block with every template."""

import random
import re

import pytest

from tripmart.llm import catalog, licenses
from tripmart.llm.licenses import TEMPLATES, THRESHOLD, UNITS, templates

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def brute(text, given=TEMPLATES, phrases=licenses.PHRASES, threshold=THRESHOLD):
    text = text or ""
    row = words(text)
    starts, base = [], set()
    for phrase, label in phrases.items():
        p = words(phrase)
        at = [i for i in range(len(row) - len(p) + 1) if row[i : i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    lines = text.split("\n")
    paragraphs, held = [], []
    for line in [*lines, ""]:
        held.append(line)
        if not line.translate({i: None for i in (9, 10, 11, 12, 13, 32)}):
            paragraphs.append(" ".join(held))
            held = []
    labels, best = set(base), 1.0 if starts else 0.0
    for unit, blocks in (("line", lines), ("paragraph", paragraphs)):
        for block in blocks:
            of = set(words(block))
            hits = []
            for t in templates(given):
                own = {w.decode() for w in t.words}
                if t.unit == unit and len(own & of) >= threshold * len(own) - 1e-9:
                    hits.append((len(own & of) / len(own), len(own & of), t.label))
            labels |= {label for share, common, label in hits if (share, common) == max(hits)[:2]}
            best = max([best, *[h[0] for h in hits]])
    return len(row), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels), best


def result(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score


def test_words_are_those_of_the_pattern():
    text = "MIT-License ÀÉ x1_y @Z[`{ \x7f ß²퟿"
    assert [w.decode() for w in licenses.words(text.encode())] == words(text)


def test_random_texts(spark):
    pick = random.Random(5)
    notices = [t[2] for t in TEMPLATES]
    rows = []
    for i in range(300):
        lines = []
        for _ in range(pick.randrange(8)):
            row = pick.choice(notices).split()
            kind = pick.randrange(5)
            if kind == 0:
                row = [w for w in row if pick.random() < 0.8]
            elif kind == 1:
                row = row + pick.choice(notices).split()
            elif kind == 2:
                pick.shuffle(row)
            elif kind == 3:
                cut = pick.randrange(len(row))
                row = row[:cut] + ["\n"] + row[cut:]
            lines.append(" ".join(row) if kind < 4 else "")
        rows.append((i, pick.choice(["\n", "\n\n", " \n \n"]).join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.id: result(r) for r in licenses.scan(docs).collect()}
    texts = dict(rows)
    assert got == {i: brute(t) for i, t in texts.items()}
    assert sum(bool(r[5]) for r in got.values()) > 100


@pytest.mark.parametrize("threshold", [0.3, 0.6, 1.0])
def test_any_threshold_loses_no_pair(spark, threshold):
    pick = random.Random(7)
    letters = "a b c d e f g h i j k l m n".split()
    given = tuple((f"l{i}", pick.choice(UNITS), " ".join(pick.sample(letters, pick.randrange(1, 9)))) for i in range(12))
    rows = [(i, "\n".join(" ".join(pick.choices(letters, k=pick.randrange(9))) for _ in range(4))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.id: result(r) for r in licenses.scan(docs, given=given, phrases={"a b": "ab", "n": "n"}, threshold=threshold).collect()}
    assert got == {i: brute(t, given, {"a b": "ab", "n": "n"}, threshold) for i, t in rows}


def test_similar_notices_are_told_apart(spark):
    texts = {1: "Licensed under CC BY 4.0.", 2: "licensed under CC BY-NC 4.0", 3: "Licensed under CC-BY-NC-SA 4.0!", 4: "the license of the kind"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.id: r.labels for r in licenses.scan(docs).collect()}
    assert got == {1: ["cc-by"], 2: ["cc-by-nc"], 3: ["cc-by-nc-sa"], 4: []}


def test_phrases_reach_over_slices(spark, monkeypatch):
    monkeypatch.setattr(licenses, "SLICE_BYTES", 3)
    finder = licenses._Phrases(licenses.PHRASES)
    assert finder.of(b"the general\npublic\nlicense MIT\n\nlicense\n") == (6, [1, 4], {"gpl", "mit"})


def test_tricky_rows(spark, tricky, nothing):
    rows = licenses.scan(tricky).collect()
    source = tricky.select("doc_id", "text").collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1:2])
    assert sorted([(r.id, *result(r)) for r in rows], key=key) == sorted([(i, *brute(t)) for i, t in source], key=key)
    assert licenses.scan(nothing).count() == 0


def test_repeated_rows_and_null_ids_keep_their_number(spark):
    rows = [(None, "MIT License")] * 50 + [(4, "Released under the MIT License")] * 3 + [(4, None)] * 2 + [(None, "nothing")]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(found) == len(rows)
    assert sorted((r.id or 0, r.labels) for r in found) == sorted((i or 0, brute(t)[5]) for i, t in rows)


def test_query(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in catalog.op13_license_blocks(spark, sf_dir).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        n, n_base, first, last, base, labels, score = brute(text)
        r = rows.pop(doc_id)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, n_base, first, last)
        assert (r.base_labels, r.labels, r.score) == (",".join(base), ",".join(labels), score)
    assert not rows
