"""The corpus pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes each as Parquet and reads it again as the next
one's input. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, curriculum, language_id, line_dedup, simhash
from tripmart.workspace import materialise

#: Least share of a text's n-grams that its language must have.
MIN_LANGUAGE_SHARE = 0.3
#: Near copies are documents whose fingerprints of shingles of so many words differ in so many bits at most.
SHINGLE, RADIUS = 4, 4


#: Columns that stages read or write; others of the user's are named out of the way of what operators add.
_OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[c if c in _OWN else f"extra {i}" for i, c in enumerate(docs.columns)])


def _as_before(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(f"`{a}`").alias(c) for a, c in zip(_apart(docs).columns, docs.columns, strict=True)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter (null and empty ones too), and texts hardly like any learned language, go. An empty table, and one without
    labels to learn from, gives an empty one."""
    known = docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 != 2)
    found = language_id.identify(_apart(docs), language_id.learn(known), keep_text=True)
    kept = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_share") >= MIN_LANGUAGE_SHARE)
    return _as_before(found.where(kept), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; documents that were nothing else go with them. Null and empty texts stay as they are; of repeated rows the
    first occurrence keeps its lines. An empty table stays empty."""
    left = line_dedup.dedup_lines(_apart(docs)).where((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _as_before(left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that fingerprints link (operator 7: words by fours, at most four bits) the document with the smallest id stays,
    once. Documents without id come last; rows of one id with different texts are documents of their own. Null and empty texts
    are one group. An empty table stays empty."""
    return simhash.one_of_each_group(docs, shingle=SHINGLE, radius=RADIUS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in the order of training. A text without words has size 0 and is taken with its
    neighbours; rows without id are ordered by a hash of their text. An empty table stays empty."""
    return _as_before(curriculum.arranged(_apart(docs)), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of the text they decode to; null and empty texts have no ids. Repeated rows are encoded one by
    one. An empty table gives an empty one."""
    content = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    decoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), content)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mix", mix),
    ("tokens", tokens),
]

#: SQL cannot express n-gram filters, XXH64 fingerprints or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
