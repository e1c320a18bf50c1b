"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerflow.llm import embeddings, html, language, licenses, lm, mixing, negatives, packing, quality, secrets, simhash, trie, warc
from offerflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    labels = F.array_union(base, F.transform("matches", lambda m: m["label"]))
    starts = F.transform("places", lambda p: p["start"])
    score = F.when(F.size("places") > 0, 1.0).otherwise(
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"))


@query
def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(order: int) -> Column:
        return F.size(F.filter("base", lambda s: s["order"] == order)).cast("long")

    base = F.filter("spans", lambda s: s["order"] < secrets.BASE)
    found = secrets.find_secrets(table(spark, sf_dir, "documents")).select("row.doc_id", "spans", base.alias("base"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("key").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.when(F.col("type") == "revisit", "revisit").otherwise("response").alias("record_type"), "refers_to")


@query
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumnRenamed("key", "doc_id")


@query
def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.vector_groups(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.col("key").eqNullSafe(F.col("component")).alias("kept"))


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.judged(docs, table(spark, sf_dir, "labels"), keep=False)
    return found.withColumnRenamed("key", "doc_id")


@query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.rebuilt(trie.digests(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(turns, convs)


@query
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = language.identified(table(spark, sf_dir, "documents"), fold != 2)
    return found.withColumnRenamed("key", "doc_id").select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
