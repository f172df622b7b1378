"""Registered queries of the operators, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsreports.llm import covertree, encoding, jaccard, language, merkle, packing, pages, pii, postings, repeats, secrets, sketches, trie, twins
from opsreports.llm.common import table
from opsreports.session import configure, fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op11_trie": twins.OP11, "op12_decontamination": twins.OP12, "op13_manifest": twins.OP13}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Registers a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {**QUERIES, "pipeline": corpus_pipeline.run}


def all_sql() -> dict[str, str]:
    import corpus_pipeline

    return SQL if corpus_pipeline.ORACLE_SQL is None else {**SQL, "pipeline": corpus_pipeline.ORACLE_SQL}


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose hash sets them aside for learning."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.learn(docs.where(~held))
    out = language.identify(docs, model)
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and what they decode to, as digests."""
    out = encoding.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens."""
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of near vectors of the same label and its component."""
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by a ledger that this run begins."""
    docs = table(spark, sf_dir, "documents")
    ledger = secrets.BlobLedger(spark, fresh_dir(spark, "ledger"))
    ledger.update(docs)
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return ledger.spans(docs).select(
        "doc_id", *[number(r.kind) for r in secrets.BASE], F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


#: For the checks only: real runs pass a key of their own.
CHECK_KEY = "check"


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents")
    return pii.pseudonymise(docs, CHECK_KEY, count_col="n_replaced").select("doc_id", "text", "n_replaced")


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited version, and how like they are, and the next document."""
    digest = {"edited_sha256": F.sha2("edited", 256)}
    rows = sketches.compare_versions(table(spark, sf_dir, "documents"), digests=sketches.even_digests, take=digest)
    near = lambda other, apart: sketches.likeness(F.col("own"), F.col(other), F.col(apart))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", sketches.written(F.col("own_cells")).alias("fingerprint"),
        sketches.written(F.col("changed_cells")).alias("edited_fingerprint"), near("changed", "to_edited").alias("near_edited"),
        near("following", "to_next").alias("near_next"),
    )


@query
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses when bytes go that lie in a 100-byte string seen before."""
    found = repeats.find_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "address").alias("kept_sha256"),
    )


@query
def op1_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest one it reaches over similar shingle sets."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = pages.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "nearest", "n_shared")


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf of the manifest, its proof, and the root that it, or its tampered version, leads to."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = [F.try_add(F.col(c), F.lit(1)) if c == "n_chars" else F.col(c) for c in fields]
    tampered = F.when(hit, merkle.leaf(*more)).alias("tampered")
    out = merkle.manifest(docs, merkle.leaf(*[F.col(c) for c in fields]), keep=[F.col("doc_id"), tampered])
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words that stand in a window of a benchmark item."""
    out = postings.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that begin with some of the first turns of every fifth one."""
    convs = trie.conversations(table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 5
    heads = convs.where(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    both = convs.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return trie.prefix_trie(both.select("conv_id", F.concat(head, own).alias("turns")))
