"""Token counts with a digest cache: only distinct texts that were never seen are encoded."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm import tokens

SCHEMA = "digest string, n_tokens long"


def read_cache(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def count_tokens(
    df: DataFrame, tokenizer: str, cache: str, key: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """One row per row of ``df``: key, n_bytes, n_tokens, over_limit.

    ``cache`` is a folder on shared storage with a table per tokenizer version (digest of its
    file). Texts are known by the SHA-256 of their content; null counts as the empty text,
    and nothing else is normalised, since the tokenizer tells all other texts apart. Texts
    without a stored count are reduced to one row each before they move, encoded, and
    appended; then every row looks its count up. A job that dies before the append leaves the
    cache as it was; two jobs that append the same text store the same count, and readers
    take one of them. Null keys and repeated rows pass through.
    """
    spark = df.sparkSession
    path = f"{cache.rstrip('/')}/tokenizer={tokens.file_digest(tokenizer)}"
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(content.cast("binary"), 256).alias("digest")
    texts = df.select(digest, content.alias("content"))
    held = read_cache(spark, path)
    if held is not None:
        texts = texts.join(held, "digest", "left_anti")
    misses = texts.groupBy("digest").agg(F.first("content").alias("content"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = tokens.ByteLevelCounts(tokenizer)
        for batch in batches:
            yield pd.DataFrame(
                {"digest": batch["digest"], "n_tokens": counts(batch["content"].tolist())}
            )

    misses.mapInPandas(encode, SCHEMA).write.mode("append").parquet(path)
    counts = read_cache(spark, path).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    return (
        df.select(F.col(key), F.octet_length(content).cast("long").alias("n_bytes"), digest)
        .join(counts, "digest")
        .select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
