"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

Words are counted over the whole corpus; the most frequent ones, with their ids, are compiled into a minimal automaton
(``lexicon.py``), which is written to the shared folder, shipped to every executor by Spark, and mapped into memory there.
A word that is not in it is merged by rank, exactly (by the tokenizers library's merges, many words a call), so the size of the lexicon decides speed and never results.

The size of the lexicon is a parameter; it and the vocabulary are all that passes through the driver. Texts are not
shuffled; words are, combined per task first.

Null and empty texts have no ids and decode to empty text. Repeated rows are encoded one by one. Extra columns stay; one
called like the new column is replaced. An empty table gives an empty table (and an empty lexicon).
"""

from __future__ import annotations

import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import pieces, schema_with, with_columns
from tripmart.llm.lexicon import Lexicon, compile_lexicon
from tripmart.llm.word_bpe import Speller, Vocabulary, by_words
from tripmart.workspace import materialise, session_root, write_bytes

LEXICON_WORDS = 65_536
#: A task hands on its word counts when it holds so many distinct words.
COUNTED_WORDS = 200_000


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, a few MB, read where the job is planned and sent along."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=1)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def word_counts(docs: DataFrame, content: bytes, text_col: str = "text") -> DataFrame:
    """Every word of the corpus, as the tokenizer cuts and normalises it, with its number of occurrences."""

    def run(batches):
        vocabulary, seen = _vocabulary(content), Counter()

        def out():
            words = Counter()
            for chunk, n in seen.items():
                for word in () if isinstance(chunk, int) else vocabulary.words(chunk):
                    words[word] += n
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"]
            )

        for batch in pieces(batches, text_col):
            for text in batch.column(text_col).to_pylist():
                if text:
                    seen.update(vocabulary.chunks(text))
            if len(seen) > COUNTED_WORDS:
                yield out()
        yield out()

    return docs.select(text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, words: int = LEXICON_WORDS) -> list[str]:
    """The words from some number of occurrences on, as many as fit into ``words``. The number is found on a logarithmic
    scale of some hundred steps, so what reaches the driver is that histogram and the words."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    room, least = words, None
    for row in sorted(sizes, reverse=True):
        room -= row.words
        if room < 0:
            break
        least = row.step
    return [r.word for r in counts.where(step >= least).select("word").collect()] if least is not None else []


def build_lexicon(docs: DataFrame, content: bytes, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words and return the name under which executors find the file."""
    spark = docs.sparkSession
    top = frequent_words(materialise(word_counts(docs, content, text_col), "word-counts"), words)
    vocabulary = _vocabulary(content)
    compiled = compile_lexicon((word.encode(), vocabulary.merge(word)) for word in top)
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    path = f"{session_root(spark)}/{name}"
    write_bytes(spark, path, compiled)
    spark.sparkContext.addFile(path)
    return name


def _speller(content: bytes, name: str) -> Speller:
    """A task has its own, so what it remembers goes with it."""
    vocabulary, lexicon = _vocabulary(content), Lexicon(SparkFiles.get(name))

    def known(words: list[str]):
        return lexicon.look_up([w.encode() for w in words])

    return Speller(vocabulary, by_words(vocabulary, known))


def _encoder(content: bytes, name: str, text_col: str, out: str):
    """A task: batches with the ids of each text in place of the text."""

    def run(batches):
        speller = _speller(content, name)
        for batch in pieces(batches, text_col):
            rest = batch.select([n for n in batch.schema.names if n != text_col])
            yield with_columns(rest, **{out: speller.spell(batch.column(text_col).to_pylist())})

    return run


def _decoder(spelling: list[str], ids_col: str, out: str):
    """A task: batches with the text of each id list."""

    def run(batches):
        tokens = pa.array(spelling, pa.string())
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                lists = part.column(ids_col)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                spelled = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), tokens.take(pc.list_flatten(lists)))
                yield with_columns(part, **{out: pc.binary_join(spelled, " ")})

    return run


def encode(docs: DataFrame, content: bytes, text_col: str = "text", out: str = "ids", lexicon: str | None = None) -> DataFrame:
    """The documents with the ids of each text in place of the text."""
    name = lexicon or build_lexicon(docs, content, text_col)
    return docs.mapInArrow(_encoder(content, name, text_col, out), schema_with(docs.drop(text_col), **{out: "array<int>"}))


def decode(encoded: DataFrame, content: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of each id list: the tokens, word-end marks included, joined by a blank, as a file without
    a decoder prescribes. A null list decodes to empty text."""
    spelling = _vocabulary(content).tokens  # all that decoding needs of the file, sent along
    return encoded.mapInArrow(_decoder(spelling, ids_col, out), schema_with(encoded, **{out: "string"}))


def round_trip(
    docs: DataFrame, content: bytes, text_col: str = "text", ids: str = "ids", decoded: str = "decoded", lexicon: str | None = None
) -> DataFrame:
    """``decode`` of ``encode``, by one Python worker a task, where the two by themselves hold one each: ids are decoded where they
    are made."""
    name = lexicon or build_lexicon(docs, content, text_col)
    encoder = _encoder(content, name, text_col, ids)

    def run(batches):
        yield from _decoder(_vocabulary(content).tokens, ids, decoded)(encoder(batches))

    return docs.mapInArrow(run, schema_with(docs.drop(text_col), **{ids: "array<int>", decoded: "string"}))
