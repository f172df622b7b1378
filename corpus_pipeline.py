"""Corpus preparation: filter, link, clean, mask and pack documents, one written stage after another."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsreports.llm import jaccard, language, packing, pii, repeats
from opsreports.llm.common import settle, table
from opsreports.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: For the checks only: real runs pass a key of their own.
KEY = "check"


def bounded(docs: DataFrame) -> DataFrame:
    """The same frame; from now on its session sends texts to Python in batches of a few MB, however long the texts are."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return docs


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told by compression; the others go. ``lang`` stays as stated.

    Only id and text go through Python, and only the few that are rejected come back to be left out.
    """
    model = language.learn(bounded(docs))
    marked = docs.withColumn("_mark", F.xxhash64("text"))
    found = language.identify(marked, model, margin=0.002, keep=["_mark"]).where("rejected")
    gone = settle(found.select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_gone")).distinct(), "rejected")
    same = marked["doc_id"].eqNullSafe(gone["_id"]) & (marked["_mark"] == gone["_gone"])
    return marked.join(gone, same, "left_anti").select(COLUMNS)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by similar shingle sets."""
    found = jaccard.similar_documents(bounded(docs))
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the 100-byte strings that an earlier place has."""
    found = repeats.find_repeats(bounded(docs)).where(F.size("spans") > 0).select("doc_id", "address", "kept_text").distinct()
    same = (docs["doc_id"] == found["doc_id"]) & (F.sha2(docs["text"], 256) == found["address"])
    text = F.coalesce("kept_text", docs["text"])
    return docs.join(found, same, "left").select(
        docs["doc_id"], text.alias("text"), docs["lang"], docs["source"], F.length(text).cast("long").alias("n_chars")
    )


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms."""
    return pii.pseudonymise(docs, KEY).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens, with a checksum of each piece's tokens."""
    packed = packing.pack(bounded(docs), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_language),
    ("similar", keep_one_of_similar),
    ("repeats", cut_repeats),
    ("personal", mask_personal),
    ("packing", pack_sequences),
]

# The stages aren't SQL: compression, suffix arrays and tokenizers. They are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as parquet and read again for the next."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
