"""The corpus operators as named queries over their whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import (
    bpe,
    curriculum,
    exact_dedup,
    fingerprints,
    language_id,
    licenses,
    line_dedup,
    repetitions,
    simhash,
    token_shards,
    toxicity,
    warc,
    whitening,
)
from tripmart.llm.oracles import ORACLES  # noqa: F401
from tripmart.workspace import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(identity: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit(""))) % n


@query
def op1_warc_normaliser(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    streams, archives = new_path(spark, "warc-streams"), new_path(spark, "warc")
    warc.write_monolithic(warc.records(pages, min_payload=0), streams)
    warc.normalise(spark, streams, archives)
    page = lambda urn: F.regexp_extract(urn, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
    return warc.read_archives(spark, archives).select(
        page("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )


@query
def op2_toxicity_grammar(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_remainder("doc_id", 3) != 1)
    known = docs.join(F.broadcast(toxicity.sample_labels(labels)), "doc_id")
    return toxicity.score(docs, toxicity.learn(known)).select(
        "doc_id",
        (_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "matched_clauses",
    )


@query
def op3_bpe_lexicon(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    content = bpe.read_vocabulary(VOCABULARY)
    decoded = bpe.round_trip(docs, content)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_line_windows(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@query
def op5_improbable_features(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_along(docs).withColumnRenamed("id", "doc_id")


@query
def op6_token_shards(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = new_path(spark, "token-shards")
    token_shards.write_shards(docs, path, bpe.read_vocabulary(VOCABULARY), end_id=END_ID)
    return token_shards.read_shards(spark, path, as_bytes=True).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op7_simhash_covering(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = simhash.fingerprints(docs).withColumnRenamed("doc_id", "id")
    return simhash.link(prints).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op8_language_filters(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    known = docs.select("doc_id", "text", "lang").where(_remainder("doc_id", 4) != 2)
    return language_id.identify(docs.select("doc_id", "text"), language_id.learn(known)).select(
        "doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "lang_share"
    )


@query
def op9_digest_index(spark, sf_dir):
    """A new index that takes the longer half of the documents first, then the others, so a text's longest row comes first."""
    rows = materialise(exact_dedup.digests(_table(spark, sf_dir, "documents")), "all-digests")
    found = rows.agg(F.percentile_approx("length", 0.5).alias("middle"), F.count(F.lit(1)).alias("n")).first()
    shorter = F.col("length") < (found["middle"] or 0)
    name = f"digests_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}_{uuid.uuid4().hex[:8]}"
    index = exact_dedup.DigestIndex(spark, name, new_path(spark, "digest-index"), buckets=exact_dedup.buckets_for(found["n"]))
    decided = index.append_each({"longer": rows.where(~shorter), "shorter": rows.where(shorter)})
    index.close()
    return decided.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query
def op10_curriculum_mix(spark, sf_dir):
    """The mix is written in the order of training; what it holds of each document is counted in it. Documents of one id, source and
    size, as repeated rows are, have the same row but for the copies: the nth has one more for each copy that n of them have."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text", curriculum.words(F.col("text")).alias("size"))
    planned = materialise(curriculum.plan(docs), "mix-plan")
    mixed = materialise(curriculum.arranged(docs, planned=planned).drop("text"), "mix")
    alike = ["doc_id", "source", "size"]
    wanted = planned.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target")
    held = mixed.select(*alike, "training_copy")
    counted = (
        wanted.unionByName(held, allowMissingColumns=True)
        .groupBy(*alike, "training_copy")
        .agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.count(F.lit(1)).alias("n"))
        .groupBy(*alike)
        .agg(
            F.max("source_size").alias("source_size"),
            F.max("target").alias("target"),
            F.max(F.when(F.col("training_copy").isNull(), F.col("n"))).alias("rows"),
            F.collect_list(F.when(F.col("training_copy").isNotNull(), F.col("n"))).alias("having"),
        )
    )
    each = counted.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")))
    copies = F.size(F.filter("having", lambda n: n >= F.col("nth")))
    return each.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, in about a tenth of which words from one on repeat the few before, by a rule of the id's crc32."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % period))
        return F.array_join(F.concat(F.slice(words, 1, a), tail), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # in an array of one, so that the words are made once
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), 0)
    return docs.withColumn("text", F.when(h % 10 == 0, changed).otherwise(F.col("text")))


@query
def op11_word_runs(spark, sf_dir):
    found = repetitions.find_runs(with_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    greatest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short")))
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select("*", greatest.alias("top")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.short")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.short")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query
def op12_whitened(spark, sf_dir):
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed(
        "id", "vec_id"
    )


@query
def op13_license_blocks(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
