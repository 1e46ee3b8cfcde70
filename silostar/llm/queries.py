"""The registered queries: each operator over its whole table with production parameters.

Every function takes (spark, sf_dir) and returns a DataFrame; columns that only sum up an
operator's real output are derived here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silostar.llm import (
    conversation_repair, embedding_dedup, fingerprint, langid, license_scan, minhash, packing, piece_sampling,
    prefix_trie, quality, secret_scan, token_counts, url_filter,
)
from silostar.llm.common import new_path, small_batches, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(small_batches(spark), sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.duplicates(table(small_batches(spark), sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(small_batches(spark), sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(small_batches(spark), sf_dir, "documents")
    return minhash.duplicates(docs, width=4, similarity=0.8)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the pages. Likelihoods are learnt from the labelled documents."""
    docs = table(small_batches(spark), sf_dir, "documents")
    html, url = F.col("html"), F.col("url")
    return langid.identify(
        table(spark, sf_dir, "pages"), langid.fit(docs, "doc_id", "text", "lang"), "page_id",
        langid.text_of(html), langid.declared_in(html), langid.host_of(url), langid.suffix_of(url),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.RULES)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with a cache of its own, empty at the start: all distinct texts are encoded."""
    docs = table(small_batches(spark), sf_dir, "documents")
    cache = new_path(spark, "token-cache")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache)


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and whether they decode to its text."""
    docs = table(small_batches(spark), sf_dir, "documents")
    pieces = piece_sampling.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), "lossless")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p["word"].cast("long"))
    base = F.transform("places", lambda p: p["label"])
    added = F.transform("spans", lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, added)).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources; an owner's repositories are its languages."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    count = lambda spans, test: F.size(F.filter(spans, test)).cast("long")
    of = lambda kind: lambda s: s["kind"] == kind
    return found.select(
        "doc_id",
        *(count("base", of(kind)).alias(f"n_{kind}") for kind in secret_scan.BASE),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        count("spans", lambda s: s["live"]).alias("n_live"),
        count("spans", lambda s: ~s["live"]).alias("n_copied"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        *[fingerprint.listed(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")],
        "near_edited", "near_next",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_embedding_dedup, op3_packing, op4_minhash_dedup, op5_language_id, op6_url_filter,
        op7_piece_sampling, op8_license_scan, op9_token_counts, op10_secret_scan, op11_conversation_repair,
        op12_fingerprints, op13_prefix_trie,
    )
}
