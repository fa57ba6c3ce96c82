import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ROWS, peak_bytes
from tripmart.llm import fingerprints as P


def brute_rank(window, scale=P.LONG):
    size = len(window)
    cost = sum(scale.cost[1 : n + 1].sum() for n in Counter(window).values())
    most = int(math.log2(size)) * size * P._SCALE
    level = int((most - cost) * P.LEVELS // most)
    entropy = math.log2(size) - sum(n * math.log2(n) for n in Counter(window).values()) / size
    assert abs(level / P.LEVELS * math.log2(size) - entropy) < 0.02
    return int(scale.ranks[level])


def brute_windows(data, scale):
    size = scale.window
    ranks = [brute_rank(data[i : i + size], scale) for i in range(len(data) - size + 1)]
    popular = Counter()
    for s in range(len(ranks)):
        stretch = [(r, s + k) for k, r in enumerate(ranks[s : s + size]) if r <= P.LEVELS]
        if stretch:
            popular[min(stretch)[1]] += 1
    return {data[i : i + size] for i, n in popular.items() if n >= scale.popular}


def brute_features(data):
    fine = brute_windows(data, P.SHORT) if len(data) < 1024 else set()
    finest = brute_windows(data, P.TINY) if len(data) < 128 else set()
    return finest | fine | (brute_windows(data, P.LONG) if len(data) >= 512 else set())


def text(seed, n):
    draw = random.Random(seed)
    return "".join(draw.choice("etaoin shrdlu,.é\n") for _ in range(n)).encode()


def test_window_ranks_and_features():
    texts = [text(1, 600), b"", text(2, 70), b"short", b"a" * 300, text(3, 64), text(1, 600), text(4, 1_500), text(5, 16), b"ab" * 400]
    data = np.frombuffer(texts[0], np.uint8)
    assert P.window_ranks(data).tolist() == [brute_rank(texts[0][i : i + 64]) for i in range(len(texts[0]) - 63)]
    fine = P.window_ranks(data, P.SHORT).tolist()
    assert fine == [brute_rank(texts[0][i : i + 16], P.SHORT) for i in range(len(texts[0]) - 15)]
    whose, hashes = P._features(texts)
    for i, t in enumerate(texts):
        expected = len(brute_features(t))
        assert (whose == i).sum() == (expected or (1 if t else 0))
    assert hashes[whose == 0].tolist() == hashes[whose == 6].tolist()
    for i, t in enumerate(texts):  # alone or together
        assert P._features([t])[1].tolist() == hashes[whose == i].tolist()


def test_likeness():
    a, b = text(5, 4_000), text(6, 4_000)
    half = a[:2_000] + b[:2_000]
    shifted = b"xyz" + a
    one, two, mixed, moved = P.chains([a, b, half, shifted])
    assert one.likeness(one) == 1.0 and one.likeness(two) < 0.1
    assert 0.3 < one.likeness(mixed) < 0.7
    assert one.likeness(moved) > 0.9
    empty, other = P.chains([b"", b"x"])
    assert (empty.likeness(empty), empty.likeness(other), other.likeness(other), str(empty)) == (1.0, 0.0, 1.0, "")
    long = P.chains([text(7, 60_000)])[0]
    assert len(long.counts) > 1 and long.counts[:-1].tolist() == [P.FILTER_FEATURES] * (len(long.counts) - 1)


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_compare_along(spark, docs, parts):
    few = docs.limit(60).select("doc_id", "text").cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.id: r for r in P.compare_along(few).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted(few.collect(), reverse=True)
    assert len(found) == len(rows)
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        own, theirs, third = P.chains([t.encode(), changed.encode(), following.encode()])
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (str(own), str(theirs))
        assert (r.near_edited, r.near_next) == (own.likeness(theirs), own.likeness(third))


def test_short_texts_are_nearer_to_their_edit_than_to_the_next(spark, docs):
    short = docs.selectExpr("doc_id", "substring(text, 1, CAST(40 + doc_id * 7 % 160 AS INT)) AS text")
    rows = [r for r in P.compare_along(short).collect() if r.fingerprint != r.edited_fingerprint]
    assert len(rows) > 100 and sum(r.near_edited > r.near_next for r in rows) >= 0.9 * len(rows)


def test_a_text_and_its_edit_share_a_scale():
    for size in (480, 520, 1_000, 1_050):
        t, other = text(size, size), text(size + 1, size)
        one, cut, grown, another = P.chains([t, t[: size - 60], t + other[:60], other])
        assert min(one.likeness(cut), one.likeness(grown)) > 0.5 > 0.2 > one.likeness(another)


def test_rows_without_id_and_copies_are_spread(spark):
    rows = spark.range(4_000).selectExpr("IF(id % 2 = 0, NULL, id) AS doc_id", "IF(id % 4 = 0, 'the same copy', concat('text ', id)) AS text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = P.compare_along(rows.repartition(8))
        assert found.count() == 4_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    copies = found.where("id IS NULL AND n_chars = 13").groupBy("fingerprint").count().collect()
    assert [r["count"] for r in copies] == [1_000]


def test_tricky(spark, tricky, nothing):
    rows = P.compare_along(tricky).collect()
    assert len(rows) == len(ROWS)
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t, *_ in ROWS)
    assert {r.fingerprint for r in rows if r.id in (7, 8)} == {str(P.chains([ROWS[6][1].encode()])[0])}
    out = P.fingerprint(tricky)
    assert out.columns.count("fingerprint") == 1 and out.count() == len(ROWS)
    assert P.compare_along(nothing).count() == 0 and P.fingerprint(nothing).count() == 0
    one = P.compare_along(spark.createDataFrame([(1, "alone")], "doc_id int, text string")).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"aloal").hexdigest())]


@pytest.mark.parametrize("block", [100, 513, 4096])
def test_blocks_give_the_features_of_the_whole(docs, block):
    long = [r.text.encode() for r in docs.select("text").where("length(text) > 2000").limit(12).collect()]
    long += [b"ab" * 3000, b"wort und noch ein wort\n" * 200, text(5, 9000)]
    for data in long:
        assert P._block_windows(data, block).tolist() == P._windows([data], P.LONG)[2].tolist()
        assert P._features([b"short", data, b""], block)[1].tolist() == P._features([b"short", data, b""])[1].tolist()


def test_a_very_long_text_takes_little_memory():
    draw = random.Random(2)
    data = b" ".join(draw.choices([text(k, 9) for k in range(5000)], k=2_000_000))[: 20 << 20]
    assert len(data) == 20 << 20
    assert peak_bytes(lambda: P.chains([data])) < 320 << 20
