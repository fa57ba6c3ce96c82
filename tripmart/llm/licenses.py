"""License scans: phrases in place, and an exact set-similarity join of text blocks with license templates (prefix, length and
positional filters: Bayardo, Ma and Srikant, "Scaling up all pairs similarity search", 2007; Xiao et al., "PPJoin", 2008).

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Blocks are the lines of a text for templates of
one line, and its paragraphs (lines up to an empty one) for longer templates. A block holds a template if at least ``threshold`` of the
template's different words are among the block's.

The join. Each block is the set of its template words. Words are ordered by how many blocks of the whole corpus hold them, the
rarest first. A template that needs c common words out of t is found from its first t - c + 1 words alone (prefix filter), by
blocks of at least c template words (length filter) that hold such a word no deeper than c words before their own end, and only
if the words left on both sides still make c (positional filter). What passes is compared in full, so the result is that of comparing
all blocks with all templates. Where a block holds several templates, the one with the greatest share counts, then the one with most
common words; ties all count (a short notice is often part of a longer one).

Templates are a parameter: their words and prefixes are in one small table, bounded by the templates, which is broadcast. Texts are
read once and not shuffled; blocks that hold too few template words for any template end where they are read. Of the others the
numbers of their words go on. Labels come back to documents by id and a hash of the text; keys with many rows skip that shuffle.

Null and empty texts have no words, no labels and score 0. Repeated rows, and null ids, are documents of their own. Equal texts get
equal results. An empty table gives an empty table. Very long texts are worked on by a slice of lines at a time. Extra columns are left
out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import join_groups, pieces
from tripmart.workspace import materialise

#: What the scan looks for word by word.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Opening words of public license notices, with the block they fill.
TEMPLATES = (
    ("mit", "line", "Released under the MIT License"),
    ("mit", "line", "Licensed under the MIT License"),
    ("apache", "line", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "line", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "line", "Licensed under the GNU General Public License"),
    ("lgpl", "line", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "line", "Licensed under the GNU Affero General Public License"),
    ("mpl", "line", "Licensed under the Mozilla Public License, Version 2.0"),
    ("bsd", "line", "Licensed under the BSD 3-Clause License"),
    ("cc-by", "line", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "line", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "line", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "line", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "line", "Licensed under CC BY-NC-SA 4.0"),
    ("cc0", "line", "Released under CC0 1.0 Universal"),
    ("mit", "paragraph", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction"),
    ("apache", "paragraph", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "paragraph", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("bsd", "paragraph", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
)
THRESHOLD = 0.8
UNITS = ("line", "paragraph")
#: Lines are split into words so many bytes at a time.
SLICE_BYTES = 1 << 18
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_ROW = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, hash_a bigint, hash_b bigint"


def words(text: bytes) -> list[bytes]:
    """The words of UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Template:
    label: str
    unit: str
    words: frozenset[bytes]

    def needed(self, threshold: float) -> int:
        """The least number of common words; at least one."""
        return max(1, math.ceil(threshold * len(self.words) - 1e-9))


def templates(given=TEMPLATES) -> list[Template]:
    made = [Template(label, unit, frozenset(words(text.encode()))) for label, unit, text in given]
    if any(t.unit not in UNITS or not t.words for t in made):
        raise ValueError("a template needs a unit, line or paragraph, and words")
    return made


# ------------------------------------------------------------------ texts to blocks
def _slices(text: bytes) -> Iterator[bytes]:
    """The text cut after line ends."""
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + SLICE_BYTES) + 1 or len(text)
        yield text[at:end]
        at = end


class _Phrases:
    """Where phrases stand in a stream of words."""

    def __init__(self, phrases: dict[str, str]):
        self.phrases = [(words(p.encode()), label) for p, label in phrases.items()]
        self.last = {p[-1] for p, _ in self.phrases}
        self.overlap = max(len(p) for p, _ in self.phrases) - 1

    def of(self, text: bytes) -> tuple[int, list[int], set[str]]:
        """Number of words, starts of phrases, labels."""
        n, starts, labels, before = 0, [], set(), []
        for part in _slices(text):
            fresh = words(part)
            if not self.last.isdisjoint(fresh):
                row = before + fresh
                for i in range(len(before), len(row)):
                    if row[i] in self.last:
                        for phrase, label in self.phrases:
                            k = i + 1 - len(phrase)
                            if k >= 0 and row[k : i + 1] == phrase:
                                starts.append(n - len(before) + k)
                                labels.add(label)
            n += len(fresh)
            before = (before + fresh)[-self.overlap :] if self.overlap else []
        return n, starts, labels


def _blocks(text: bytes, numbers: dict[bytes, int], least: dict[str, int]) -> list[tuple[int, list[int]]]:
    """(unit, template words) of every line and paragraph that holds enough of them for a template of its unit."""
    out, paragraph = [], set()

    def close(unit: int, held: set) -> None:
        if len(held) >= least[UNITS[unit]]:
            out.append((unit, sorted(held)))

    for part in _slices(text):
        for line in part.split(b"\n") if not part.endswith(b"\n") else part[:-1].split(b"\n"):
            found = words(line)
            held = {numbers[w] for w in found if w in numbers}
            close(0, held)
            paragraph |= held
            if not line.strip():
                close(1, paragraph)
                paragraph = set()
    close(1, paragraph)
    return out


def _scanned(known: list[Template], phrases: dict[str, str], threshold: float, vocabulary: list[bytes]):
    import xxhash

    numbers = {w: i for i, w in enumerate(vocabulary)}
    least = {u: min([t.needed(threshold) for t in known if t.unit == u], default=1 << 60) for u in UNITS}
    finder = _Phrases(phrases)
    block = pa.struct([("unit", pa.int32()), ("words", pa.list_(pa.int32()))])
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def run(batches):
        for batch in pieces(batches, "text"):
            rows = {name: [] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels", "hash_a", "hash_b", "blocks")}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = text or b""
                n, starts, labels = finder.of(text)
                blocks = _blocks(text, numbers, least)
                digest = xxhash.xxh3_128_intdigest(text)
                values = (n, len(starts), min(starts, default=None), max(starts, default=None), sorted(labels),
                          signed(digest >> 64), signed(digest & (1 << 64) - 1), [{"unit": u, "words": w} for u, w in blocks])
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] + [pa.int64()] * 2 + [pa.list_(block)]
            arrays = [pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *rows])

    return run


# ------------------------------------------------------------------ the join
def containments(blocks: DataFrame, known: list[Template], vocabulary: list[bytes], threshold: float) -> DataFrame:
    """``blocks`` is a table with key columns, unit and words (numbers in the vocabulary, each once). Returns it with a row per
    template that the block holds: template (its number), common and share."""
    spark = blocks.sparkSession
    counted = {r.w: r.n for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(vocabulary)), key=lambda w: (counted.get(w, 0), vocabulary[w]))  # as many as template words
    rank = {w: r for r, w in enumerate(order)}
    number = {w: i for i, w in enumerate(vocabulary)}
    prefixes = []
    for i, t in enumerate(known):
        ranks, c = sorted(rank[number[w]] for w in t.words), t.needed(threshold)
        prefixes += [(i, UNITS.index(t.unit), c, len(ranks), r, at, ranks) for at, r in enumerate(ranks[: len(ranks) - c + 1])]
    index = spark.createDataFrame(prefixes, "template int, unit int, needed int, size int, rank int, t_at int, t_ranks array<int>")
    ranks = F.array(*[F.lit(rank[w]) for w in range(len(vocabulary))])
    ordered = blocks.withColumn("b_ranks", F.array_sort(F.transform("words", lambda w: F.get(ranks, w))))
    length = F.size("b_ranks")
    probes = ordered.select("*", F.posexplode("b_ranks").alias("b_at", "rank"))
    left = F.least(F.col("size") - F.col("t_at"), length - F.col("b_at"))
    # the index has a row per prefix word of a template, whatever the number of documents
    candidates = probes.join(F.broadcast(index), ["unit", "rank"]).where(
        (length >= F.col("needed")) & (F.col("b_at") <= length - F.col("needed")) & (left >= F.col("needed"))
    )
    common = F.size(F.array_intersect("b_ranks", "t_ranks"))
    # a pair that meets at several prefix words counts where it meets first
    meets = F.array_min(F.array_intersect("b_ranks", F.slice("t_ranks", 1, F.col("size") - F.col("needed") + 1)))
    return (
        candidates.where(F.col("rank") == meets)
        .withColumn("common", common)
        .where(F.col("common") >= F.col("needed"))
        .withColumn("share", F.col("common") / F.col("size"))
        .select(*blocks.columns, "template", "common", "share")
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    given=TEMPLATES,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: id, n_words, n_base (places of phrases), first_word and last_word (least and greatest start), base_labels, labels
    (sorted arrays), score: 1 with a phrase, else the greatest share of a template that a block holds, else 0."""
    phrases = PHRASES if phrases is None else phrases
    known = templates(given)
    vocabulary = sorted(frozenset().union(*[t.words for t in known]))
    run = _scanned(known, phrases, threshold, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = materialise(
        rows.mapInArrow(run, f"id {kind}, {_ROW}, blocks array<struct<unit: int, words: array<int>>>"), "license-blocks"
    )
    keyed = rows.withColumn("no_id", F.col("id").isNull()).withColumn("of", F.coalesce(F.col("id").cast("string"), F.lit("")))
    key = ["of", "no_id", "hash_a", "hash_b"]
    # equal texts hold equal blocks: one of them takes part in the join
    blocks = (
        keyed.where(F.size("blocks") > 0).groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.first("blocks").alias("blocks"))
        .select(*key, "copies", F.posexplode("blocks").alias("block", "of_block"))
        .select(*key, "copies", "block", "of_block.unit", "of_block.words")
    )
    blocks = materialise(blocks, "license-sets")
    held = containments(blocks, known, vocabulary, threshold)
    labels = F.array(*[F.lit(t.label) for t in known])
    best = held.groupBy(*key, "block").agg(
        F.max(F.struct("share", "common")).alias("best"),
        F.first("copies").alias("copies"),
        F.collect_set(F.struct("share", "common", "template")).alias("all"),  # as many as templates at most
    )
    is_best = lambda x: (x["share"] == F.col("best.share")) & (x["common"] == F.col("best.common"))
    named = best.select(*key, "copies", "best.share", F.explode(F.filter("all", is_best)).alias("one"))
    found = named.groupBy(*key).agg(
        F.first("copies").alias("copies"),
        F.max("share").alias("share"),
        F.collect_set(F.get(labels, F.col("one.template"))).alias("found"),
    )
    whole = join_groups(keyed.drop("blocks"), materialise(found, "license-labels"), key, "copies")
    return whole.select(
        "id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
