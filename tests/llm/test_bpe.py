import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ROWS
from tripmart.llm import bpe, word_bpe
from tripmart.llm.lexicon import Lexicon, compile_lexicon
from tripmart.llm.word_bpe import PROVEN, Speller, Vocabulary, by_library, by_words

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, World! it's they're I'LL 'd", "ﬁ ½ ① Ⅷ ² x²y", "ΣΑΣ ΟΔΟΣ Σ", "İSTANBUL ıI ẞß", "été É", "日本語 テスト 한국어 العربية हिन्दी",
    "<|startoftext|>a<|endoftext|>B <|endoftext|", "a b c​d\u0085e\x1cf\x00g", "😀👍🏽 ❤️ 🇩🇪", "__ a_b 12345 3.14 1e-5", "ααα" * 200, "x" * 5_000, "﻿bom\r\n\tok",
    "ǅ ŉ ﬀ K Å", "\U0001d400\U0001d401 ́́", "don't 's 't s't", "…—–«»„“",
]


@pytest.fixture(scope="module")
def content():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def merging(vocabulary):
    return by_words(vocabulary, lambda words: map(vocabulary.merge, words))


def expected(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_spelling_equals_the_library(content, library):
    vocabulary = Vocabulary(content)
    draw = random.Random(2)
    odd = ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 0x250), draw.randrange(0x370, 0x530), 32])) for _ in range(80)) for _ in range(300)]
    texts = TEXTS + odd
    own = Speller(vocabulary, merging(vocabulary)).spell(texts).to_pylist()
    assert own == expected(library, texts)
    assert Speller(vocabulary, by_library(vocabulary)).spell(texts).to_pylist() == own
    again = Speller(vocabulary, merging(vocabulary))
    assert [again.spell([t]).to_pylist()[0] for t in reversed(texts)] == own[::-1]
    assert Speller(vocabulary, merging(vocabulary)).spell([None, ""]).to_pylist() == [[], []]


def test_every_code_point(content, library):
    vocabulary = Vocabulary(content)
    spellers = Speller(vocabulary, by_library(vocabulary)), Speller(vocabulary, merging(vocabulary))
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or not c % 97)]
    for at in range(0, len(points), 20_000):
        texts = [t for c in map(chr, points[at : at + 20_000]) for t in (f"a{c}b 1{c}", f"{c}É x{c}. {c}{c}'s")]
        want = expected(library, texts)
        for speller in spellers:
            assert [(t, g) for t, w, g in zip(texts, want, speller.spell(texts).to_pylist(), strict=True) if w != g] == []


def test_pairs_of_proven_characters(content, library):
    vocabulary = Vocabulary(content)
    low = list(map(chr, range(1, PROVEN)))
    texts = [a + b for a in low for b in low] + [f"a{m}{c}b{m}{c} 1{m}" for m in ".,;:!?" for c in low]
    assert Speller(vocabulary, by_library(vocabulary)).spell(texts).to_pylist() == expected(library, texts)


def test_forgetting_changes_nothing(content, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "MEMO_WORDS", 6)
    monkeypatch.setattr(word_bpe, "KEPT", 3)
    vocabulary = Vocabulary(content)
    speller = Speller(vocabulary, merging(vocabulary))
    for text, ids in zip(TEXTS * 2, expected(library, TEXTS * 2), strict=True):
        assert speller.spell([text]).to_pylist() == [ids]


def test_another_kind_of_vocabulary_is_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        Vocabulary(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


def test_lexicon(tmp_path):
    draw = random.Random(4)
    words = {"".join(draw.choice("abcé") for _ in range(draw.randrange(1, 7))).encode(): [draw.randrange(9) for _ in range(draw.randrange(1, 4))] for _ in range(800)}
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(words.items()))
    lexicon = Lexicon(str(path))
    asked = [*words, b"zzz", b"", b"a" * 20, *[w + b"c" for w in words], *[w[:-1] for w in words]]
    assert lexicon.look_up(asked) == [words.get(w) for w in asked]
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).look_up([b"a", b""]) == [None, None]
    with pytest.raises(ValueError):
        (tmp_path / "other").write_bytes(b"x" * 100)
        Lexicon(str(tmp_path / "other"))


def test_suffixes_are_shared(tmp_path):
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon([((a + "ation").encode(), [1]) for a in "bcdfg"]))
    assert len(Lexicon(str(path)).finals) == 7  # one state before and after each letter, whatever the first one


@pytest.mark.parametrize("words", [0, 50, 100_000])
def test_results_do_not_depend_on_the_lexicon(spark, docs, content, library, words):
    part = docs.select("doc_id", "text").limit(50).cache()
    name = bpe.build_lexicon(part, content, words=words) if words else bpe.build_lexicon(part.limit(0), content)
    rows = bpe.decode(bpe.encode(part, content, lexicon=name), content).collect()
    texts = {r.doc_id: r.text for r in part.collect()}
    for r in rows:
        ids = expected(library, [texts[r.doc_id]])[0]
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_tricky(tricky, nothing, content, library):
    out = bpe.decode(bpe.encode(tricky, content), content)
    rows = out.collect()
    assert sorted(r.ids for r in rows) == sorted(expected(library, [t for _, t, *_ in ROWS]))
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert set(out.columns) == (set(tricky.columns) - {"text"}) | {"decoded"}
    assert bpe.decode(bpe.encode(nothing, content), content).count() == 0


def test_round_trip(tricky, nothing, content):
    apart, at_once = bpe.decode(bpe.encode(tricky, content), content), bpe.round_trip(tricky, content)
    assert at_once.schema == apart.schema
    rows = sorted(map(repr, apart.collect()))
    assert sorted(map(repr, at_once.collect())) == rows and len(rows) == len(ROWS)
    assert bpe.round_trip(tricky, content, ids="decoded", decoded="text").columns[-2:] == ["decoded", "text"]
    assert bpe.round_trip(nothing, content).count() == 0


def test_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + 1000 // (i + 1)) for i in range(300)], "word string, n bigint")
    for room in (0, 1, 10, 100, 1_000):
        found = set(bpe.frequent_words(counts, room))
        assert len(found) <= room and found == {f"w{i}" for i in range(len(found))}
    assert len(bpe.frequent_words(counts, 1_000)) == 300 and len(bpe.frequent_words(counts, 100)) > 60
    assert bpe.frequent_words(counts.limit(0)) == []
