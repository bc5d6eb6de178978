"""A training corpus from raw documents: five stages over whole tables.

Language ID drops documents without a language, line dedup takes repeated lines out, SimHash
near-dedup (wider candidates, verified exactly) keeps one document of each group, mixing
repeats or leaves out documents so that sources reach their targets, and BPE encodes what is
left. Every stage reads what its predecessor kept from Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecrate.llm import bpe, langid, linededup, mixing, similar
from tablecrate.llm.common import fold, stored, words

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Several stages are steps that SQL cannot take; the tests hold run() against plain Python.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay (null, empty and letterless texts go). A missing
    `lang` is filled in; a given one stays. Repeated rows are treated alike, an empty table
    gives an empty one."""
    labelled = docs.where(fold(F.col("doc_id"), 4) != 2)
    model = langid.fit(labelled, F.col("doc_id"))
    found = langid.identify(docs.select(*COLUMNS), model).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, or nearly, are taken out; documents with no other line
    go. Lines under `linededup.SHORTEST` code points go only if equal."""
    left = linededup.without_duplicates(docs.select(*COLUMNS))
    return left.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (Jaccard similarity of five-word shingles 0.8
    or more) stays, the one of the least id (null last; of equal ids, repeated rows included,
    any one of them). An empty table gives an empty one."""
    # Rows are numbered as they lie in files, so nothing is sorted or moved for it.
    placed = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("place")), "placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "place")
    first = similar.first_of_each(placed, order, "place").select(F.col("first.place").alias("first"))
    return placed.join(first, F.col("place") == F.col("first"), "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows of equal id, source and size are taken
    alike, sources without words not at all; an empty table gives an empty one."""
    size = F.size(words(F.col("text"))).cast("long")
    sizes = stored(docs.select(F.col("doc_id").alias("key"), F.col("source"), size.alias("size")), "sizes")
    taken = mixing.mixed(sizes).select("key", F.col("source").alias("of"), F.col("size").alias("words"), "copies").distinct()
    sized = docs.select(*COLUMNS, size.alias("size"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("key")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("words"))
    )
    copies = F.explode(F.array_repeat(F.lit(True), F.col("copies"))).alias("copy")
    return sized.join(taken.where("copies > 0"), same).select(*COLUMNS, copies).drop("copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row; null and empty texts have none."""
    found = bpe.encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
