import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import ROWS, peak_bytes
from tripmart.llm import simhash
from tripmart.llm.components import components


def brute_print(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, nodes):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        stack = [n] if n not in out else []
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = n
                stack += near[x]
    return out


def test_fingerprint(docs):
    for row in docs.select("text").limit(40).collect():
        assert simhash.fingerprint(row.text.encode()) == brute_print(row.text)
    for text in ("", " \t", "One", "a B c", "a b c d", "a b c d e", "É É É É"):
        assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_every_pair_within_the_radius_meets(radius):
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(radius)]
    draw = random.Random(radius)
    for _ in range(2_000):
        flips = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(flips & m == 0 for m in masks)
    assert all(24 <= m.bit_count() <= 40 for m in masks) or radius < 4


@pytest.mark.parametrize("cell", [2, 512])
def test_links_and_components(spark, cell):
    """Chains, a crowd that shares its buckets, and strangers."""
    draw = random.Random(1)
    prints = {draw.getrandbits(64) for _ in range(100)}
    for start in list(prints)[:10]:
        for _ in range(8):
            start ^= 1 << draw.randrange(64) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)
            prints.add(start & (1 << 64) - 1)
    crowd = draw.getrandbits(64)
    prints |= {crowd ^ 1 << b for b in range(30)}
    rows = [(i, p) for i, p in enumerate(sorted(prints))] + [(1000, crowd ^ 1), (1001, crowd ^ 1)]
    df = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in rows], "id bigint, fingerprint bigint")
    pairs = [(i, j) for i, p in rows for j, q in rows if i < j and (p ^ q).bit_count() <= 4]
    expected = brute_components(pairs, [i for i, _ in rows])
    found = {r.id: r.component_id for r in simhash.link(df, cell=cell).collect()}
    assert found == expected


@pytest.mark.parametrize("kind", ["chain", "hub", "random", "none"])
def test_components(spark, kind):
    draw = random.Random(3)
    pairs = {
        "chain": [(i, i + 1) for i in range(60)],
        "hub": [(500, i) for i in range(200)] + [(700, 700), (701, 702)],
        "random": [(draw.randrange(200), draw.randrange(200)) for _ in range(150)],
        "none": [],
    }[kind]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert found == {n: r for n, r in brute_components(pairs, linked).items()}


def test_no_pairs_are_spelled_out(spark):
    crowd = spark.createDataFrame([(1 << b,) for b in range(60)], "fingerprint bigint")
    assert simhash.near_links(crowd).count() <= 31 * 60


def test_tricky(tricky, nothing):
    rows = simhash.link(simhash.fingerprints(tricky.select("doc_id", "text")).withColumnRenamed("doc_id", "id")).collect()
    assert len(rows) == len(ROWS)
    texts = defaultdict(set)
    for i, t, *_ in ROWS:
        texts[i].add(brute_print(t))
    assert all(np.int64(r.fingerprint).view(np.uint64) in texts[r.id] for r in rows)
    assert {r.component_id for r in rows if r.fingerprint == 0} == {2}  # null, empty and blank texts
    assert {r.component_id for r in rows if r.id == 8} == {7}
    assert [r.component_id for r in rows if r.id is None and r.fingerprint != 0] == [None]
    out = simhash.fingerprints(tricky)
    assert set(out.columns) == set(tricky.columns) - {"text"} and dict(out.dtypes)["fingerprint"] == "bigint" and out.count() == len(ROWS)
    assert simhash.link(simhash.fingerprints(nothing.select("doc_id", "text")).withColumnRenamed("doc_id", "id")).count() == 0


def kept(docs):
    return sorted(((r.doc_id, r.text) for r in simhash.one_of_each_group(docs).collect()), key=str)


def test_no_text_goes_for_its_ids_sake(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, c), (9, c), (None, c), (None, b + "z")], "doc_id bigint, text string")
    assert kept(docs.repartition(4)) == sorted([(3, a), (5, b), (9, c)], key=str)


def test_rows_without_id(spark):
    a, b = ("".join(f"{x}{i} " for i in range(40)) for x in "ab")
    docs = spark.createDataFrame([(None, a), (None, a), (None, b), (2, b), (None, None), (None, "")], "doc_id bigint, text string")
    out = kept(docs)
    assert len(out) == 3 and (2, b) in out and (None, a) in out


def test_one_of_each_group(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    prints = {i: brute_print(t) for i, t in rows}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = brute_components(near, prints)
    out = simhash.one_of_each_group(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(roots.values()))


def test_one_of_each_group_tricky(tricky, nothing):
    out = simhash.one_of_each_group(tricky)
    assert out.columns == tricky.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 7, 10]
    assert simhash.one_of_each_group(nothing).count() == 0


@pytest.mark.parametrize("limit", [1, 7, 40, 1000])
def test_runs_of_words_give_the_fingerprint_of_the_whole(docs, limit):
    texts = [r.text for r in docs.select("text").limit(15).collect()]
    for text in [*texts, "", " \t", "One", "a B c", "  a b c d ", "a b c d e\n\x0b f", "x" * 100, "É É É É " * 30]:
        assert simhash.fingerprint((text or "").encode(), limit=limit) == brute_print(text)


def test_a_very_long_text_takes_little_memory():
    text = b"some words that go on and on without an end to them " * 400_000
    assert peak_bytes(lambda: simhash.fingerprint(text)) < 200 << 20
