"""The queries of the operators: (spark, sf_dir) -> DataFrame, always over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecrate.llm import (
    bpe, codes, extraction, langid, lempelziv, licenses, linededup, mixing, negatives, oracles, quality, rules, simhash,
    substrings,
)
from tablecrate.llm.common import fold, stored, with_facts, words

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, TOKENIZER, keep=["doc_id"], memory=3).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_lempelziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempelziv.with_edited(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out), F.col("doc_id"))
    named = docs.select("doc_id", "text", held_out.alias("held_out"))
    return langid.identify(named, model, keep=["doc_id", "held_out"])


def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extraction.extracted(pages, keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_classes(table(spark, sf_dir, "documents")).drop("body")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = stored(quality.with_statistics(docs.select("doc_id", "text"), keep=["doc_id"]), "statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.fit(measured.where(~held_out).join(labels, "doc_id"))
    return quality.scored(measured, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(docs).drop("text")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select(F.col("doc_id").alias("key"), "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    return mixing.mixed(stored(sizes, "sizes")).select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licenses.license_scan(docs, keep=["doc_id"])
    base = F.col("base.label")
    kept = F.col("found.weight")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("found.label"))), ",").alias("labels"),
        F.coalesce(F.array_max(kept), F.lit(0.0)).alias("score"),
    )


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    mixed_up = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", mixed_up), F.col("vec_id") % 50 == 0)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = codes.compressed(rows, keep=["vec_id", "label"])
    coded = stored(coded, "codes")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return with_facts(coded, errors, "label", "of", F.col("vec_id")).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.codebooks_sha256(books)).alias("codebooks_sha256")
    )


def llm_queries() -> dict[str, Query]:
    named = (
        op1_bpe, op2_lempelziv, op3_simhash, op4_language, op5_extraction, op6_lines, op7_quality, op8_rules, op9_mixing,
        op10_licenses, op11_substrings, op12_negatives, op13_codes,
    )
    return {query.__name__: query for query in named}


def llm_oracles() -> dict[str, str]:
    return {
        "op8_rules": oracles.OP8_RULES, "op9_mixing": oracles.OP9_MIXING, "op11_substrings": oracles.OP11_SUBSTRINGS,
        "op12_negatives": oracles.OP12_NEGATIVES, "op13_codes": oracles.op13_codes(),
    }
