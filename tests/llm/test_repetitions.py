"""Periodic runs against a brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import CLASHES
from tripmart.llm import catalog
from tripmart.llm.repetitions import SquareCatcher, dropped, find_runs, text_runs


def all_runs(x, min_length=12):
    found, n = {}, len(x)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and x[i] == x[i + q]:
                i += 1
            if i > start and i - start + q >= max(min_length, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def caught(x, min_length, steps):
    catcher, at = SquareCatcher(min_length), 0
    while at < len(x):
        step = next(steps)
        catcher.append(np.array(x[at : at + step], np.int64))
        at += step
    return catcher.runs()


def forever(values):
    while True:
        yield from values


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 3), max_size=90),
    st.integers(1, 9),
    st.integers(0, 5),
    st.sampled_from([2, 4, 12]),
    st.lists(st.integers(1, 40), min_size=1, max_size=5),
)
def test_runs_are_those_of_a_brute_force_however_words_are_appended(x, period, times, min_length, steps):
    x = x + x[-period:] * times
    want = all_runs(x, min_length)
    assert caught(x, min_length, forever(steps)) == want
    assert caught(x, min_length, forever([1])) == want


@pytest.mark.parametrize("seed", range(8))
def test_long_periods_and_nested_runs(seed):
    pick = random.Random(seed)
    x = [pick.randrange(200) for _ in range(pick.randrange(200, 500))]
    inner = x[:7] * 4
    x = x + x[100:] + inner + x[50:60] * 3 + [pick.randrange(3) for _ in range(100)] + inner[3:]
    assert caught(x, 12, forever([len(x)])) == caught(x, 12, forever([13, 1, 64])) == all_runs(x)


def test_strings_with_very_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert caught(b, 2, forever([100])) == all_runs(b, 2)
    assert caught([5] * 3000, 12, forever([1000])) == [(0, 3000, 1)]


def test_texts_of_a_piece_are_told_apart():
    texts = [b"a b " * 6, b"a b " * 6, b"", b" \t\n\x0b\x0c\r ", "x y   ".encode() * 12, b"a b a b a b a b a b a"]
    counts, runs, collapsed = text_runs(texts)
    assert counts == [12, 12, 0, 0, 24, 11]
    assert runs == [[(0, 12, 2)], [(0, 12, 2)], [], [], [(0, 24, 2)], []]
    assert collapsed[0] == b"a b" and collapsed[2] == collapsed[3] == b"" and collapsed[5] == texts[5]


def test_words_of_any_run_after_its_first_period_go():
    assert np.flatnonzero(dropped(20, [(0, 12, 3), (8, 12, 6)])).tolist() == list(range(3, 12)) + list(range(14, 20))


def test_long_text_in_pieces():
    words = [f"w{i % 4001}" for i in range(300_000)]
    counts, runs, collapsed = text_runs([" ".join(words).encode()])
    assert counts == [300_000] and runs == [[(0, 300_000, 4001)]]
    assert collapsed[0].decode().split() == words[:4001]


def test_tricky_rows(tricky, nothing):
    rows = find_runs(tricky).collect()
    assert len(rows) == tricky.count()
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 9)} == {0}
    assert all(r.collapsed == "" and r.runs == [] for r in rows if r.doc_id in (2, 3, 9))
    long = [r for r in rows if r.doc_id in (7, 8)]
    assert all([tuple(x) for x in r.runs] == [(0, 150_000, 5)] and r.collapsed == "wort und noch ein wort" for r in long)
    assert all(r[name] == "x" for r in rows for name in CLASHES if name != "n_words")
    assert find_runs(nothing).count() == 0


def test_query(spark, sf_dir, docs):
    pattern = re.compile("[^\x20\x09-\x0d]+")
    rows = {r.doc_id: r for r in catalog.op11_word_runs(spark, sf_dir).collect()}
    with_runs = 0
    texts = docs.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        words = pattern.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue  # the brute force is slow
        runs = all_runs(words)
        got = rows[doc_id]
        assert got.n_runs == len(runs)
        digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        gone = dropped(n, runs)
        kept = hashlib.sha256(" ".join(w for w, x in zip(words, gone, strict=True) if not x).encode()).hexdigest()
        assert (got.runs_sha256, got.collapsed_sha256) == (digest, kept)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (got.start, got.length, got.period) == top
        assert got.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        with_runs += bool(runs)
    assert with_runs > 5
