import tracemalloc

import pytest

#: Names that the operators use inside, as extra columns of the input.
CLASHES = {"id": "x", "n": "x", "score": "x", "ids": "x", "starts": "x", "digest": "x", "root": "x", "key": "x", "size": "x", "copies": "x",
           "training_position": "x", "lines_removed": "x", "fingerprint": "x", "lang_pred": "x", "task": "x", "edge": "x",
           "_hash": "x", "_lines": "x", "_kept": "x", "_a": "x", "_b": "x", "_places": "x", "_positions": "x", "starts_at": "x", "d": "x", "l": "x",
           "no_id": "x", "row": "x", "row_a": "x", "lang_share": "x", "blocks": "x", "hash_a": "x", "of": "x", "n_words": "x"}
LONG = "wort und noch ein wort\n" * 30_000
ROWS = [
    (1, "a b c d e f\nzwei\ndrei\nvier", "de", "s0"),
    (2, None, "de", None),
    (3, "", None, "s1"),
    (3, "", None, "s1"),
    (None, "ohne nummer", "de", "s0"),
    (None, None, None, None),
    (7, LONG, "de", "s0"),
    (8, LONG, "de", "s0"),
    (9, " \t\n\n\x0b ", "fr", "s1"),
    (10, "l'été s'en va <|endoftext|> ΑΣ İstanbul 3½ 😀", "fr", "s1"),
]


def peak_bytes(run):
    """The most memory that Python and numpy hold beyond what they held before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="session")
def tricky(spark):
    """Null ids, null and empty texts, repeated rows, very long texts, columns with clashing names."""
    rows = [(*row, *CLASHES.values()) for row in ROWS]
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars int, {names}"
                                 .replace("n_chars int, ", "")).repartition(3)


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
