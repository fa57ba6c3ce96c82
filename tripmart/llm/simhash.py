"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, "CoveringLSH", 2016).

A fingerprint is the bitwise majority of the hashes of a text's word shingles. Two fingerprints link if they differ in
at most ``radius`` bits. Each of the 64 positions gets a non-zero vector m of radius + 1 bits; table v, for every
non-zero v, keeps the positions where m and v have an odd number of common ones. The at most ``radius`` positions in
which a linked pair differs cannot span all radius + 1 dimensions, so some v ignores them all: every linked pair meets in
some table, with certainty. For radius 4 that is 31 tables of about 32 kept positions.

Only distinct fingerprints are searched, so exact copies cost nothing. Buckets of one fingerprint are left out by a
count. A bucket of more than CELL fingerprints is dealt over cells, one for each pair of its parts, so that no task holds
more than 2 * CELL of them and every pair is compared in some cell. A cell returns the links of a spanning forest of what
it found, not all pairs.

Null text counts as empty. A text without words has fingerprint zero and links like any other. Fewer words than a shingle
make one shingle of all words. A very long text is read in runs of words. Rows with a null id take part; a component of
such rows alone has a null id. Repeated rows are documents of their own. Extra columns are ignored by ``link``;
``fingerprints`` keeps them, and replaces one called like its new column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import PIECE_BYTES, join_groups, pieces, schema_with, text_bytes, with_columns
from tripmart.llm.components import components
from tripmart.workspace import materialise

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
CELL = 512
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_runs(text: bytes, overlap: int, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of the UTF-8 of a text, A-Z in lower case, between ASCII white space, in runs of about ``limit`` bytes. Each run but
    the first begins with the last ``overlap`` words of the one before, or all if there are fewer."""
    held: list[bytes] = []
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + limit)
        end = space.start() if space else len(text)
        words = text[at:end].lower().split()
        if words:
            words = held + words
            yield words
            held = words[-overlap:] if overlap else []
        at = end + 1


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of so many words, repeats included."""
    from xxhash import xxh64_intdigest

    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cuts = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array(list(map(xxh64_intdigest, [line[a:b] for a, b in cuts], repeat(SEED))), dtype="<u8")


def fingerprint(text: bytes, shingle: int = SHINGLE, limit: int = PIECE_BYTES) -> int:
    """The majority of each bit over the hashes of the shingles, ties to 0. A longer text than ``limit`` is read run by run."""
    ones, total = np.zeros(BITS, np.int64), 0
    words: list[bytes] = []
    for words in word_runs(text, shingle - 1, limit):
        if len(words) < shingle:
            continue
        array = shingle_hashes(words, shingle)
        total += len(array)
        for at in range(0, len(array), 1 << 16):
            part = array[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if words and not total:  # fewer words than a shingle, and the last run has them all
        return int(shingle_hashes(words, len(words))[0])
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """The documents with their fingerprint as a signed 64-bit number in place of the text."""

    def run(batches):
        for batch in pieces(batches, text_col):
            prints = np.array([fingerprint(t, shingle) for t in text_bytes(batch, text_col)], dtype=np.uint64)
            rest = batch.select([n for n in batch.schema.names if n != text_col])
            yield with_columns(rest, **{out: pa.array(prints.view(np.int64))})

    rest = docs.drop(text_col) if text_col != out else docs.drop(out)
    return docs.mapInArrow(run, schema_with(rest, **{out: "bigint"}))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask per table, as signed 64-bit numbers."""
    size = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i in range(bits) if ((1 + i % size) & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _forest(cell: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (each row to the first row of its group) among rows that lie cell by cell."""
    n = len(cell)
    label = np.arange(n)
    found_a, found_b = [], []
    for d in range(1, n):
        same = np.flatnonzero(cell[d:] == cell[:-d])
        if not len(same):
            break
        near = same[np.bitwise_count(prints[same] ^ prints[same + d]) <= radius]
        found_a.append(near)
        found_b.append(near + d)
    if not found_a:
        return prints[:0], prints[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    out = np.flatnonzero(label != np.arange(n))
    return prints[out], prints[label[out]]


def _links(radius: int):
    def run(batches):
        held = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            prints = batch.column("fingerprint").to_numpy().view(np.uint64)
            if held is not None:
                cell, prints = np.concatenate([held[0], cell]), np.concatenate([held[1], prints])
            last = np.flatnonzero(cell != cell[-1])  # the last cell may go on in the next batch
            cut = last[-1] + 1 if len(last) else 0
            held = cell[cut:], prints[cut:]
            if cut:
                a, b = _forest(cell[:cut], prints[:cut], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)
        if held is not None:
            a, b = _forest(*held, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """``prints`` is a table of distinct values in column fingerprint. Returns links a, b that connect exactly the
    fingerprints that links of at most ``radius`` bits connect."""
    masks = F.array(*[F.lit(m) for m in covering_masks(radius)])
    rows = prints.select("fingerprint", F.posexplode(masks).alias("table", "mask")).select(
        "fingerprint", F.xxhash64("table", F.col("fingerprint").bitwiseAND(F.col("mask"))).alias("key")
    )
    shared = materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    parts = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    dealt = (
        rows.join(shared.hint("merge"), "key")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fingerprint")
    )
    return dealt.repartition("cell").sortWithinPartitions("cell", "fingerprint").mapInArrow(
        _links(radius), "a bigint, b bigint"
    )


def link(docs: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """``docs`` has columns id and fingerprint (signed). Returns id, fingerprint, component_id: the smallest id that
    links reach, and component_size."""
    docs = materialise(docs.select("id", "fingerprint"), "fingerprints")
    distinct = materialise(
        docs.groupBy("fingerprint").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "distinct"
    )
    roots = components(near_links(distinct.select("fingerprint"), radius, cell))
    placed = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", "copies", F.coalesce("root", "fingerprint").alias("root")
    )
    placed = materialise(placed, "placed")
    groups = materialise(
        placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("component_size")),
        "groups",
    )
    by_print = placed.join(groups, "root").select("fingerprint", "copies", "component_id", "component_size")
    return join_groups(docs, materialise(by_print, "by_print"), ["fingerprint"], "copies").select(
        "id", "fingerprint", "component_id", "component_size"
    )


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The documents less all but one row of each group that links connect. The row with the smallest id stays; rows without id
    come after all others, and rows of one id are ordered by a hash of the whole row. Of rows equal in every column one stays.
    Rows of one id with different texts are nodes of their own, so no text goes for its id's sake. All columns stay."""
    every = [x for name in docs.columns for x in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    row = [F.xxhash64(*every).alias("row_a"), F.xxhash64(F.lit(1), *every).alias("row_b")]
    node = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), *row)
    prints = fingerprints(docs.select(node.alias("id"), F.col(text_col).alias("text")), "text", "fingerprint", shingle)
    heads = link(prints, radius).where("id = component_id").select("id.row_a", "id.row_b").distinct()
    whole = docs.select(*row, F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    return whole.dropDuplicates(["row_a", "row_b"]).join(heads.hint("merge"), ["row_a", "row_b"], "left_semi").select("row.*")
