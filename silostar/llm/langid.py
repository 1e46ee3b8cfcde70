"""Language of texts by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text's character trigrams, the
language declared in the markup, the suffix of the address, and a prior of the host. What a
declaration, a suffix and a host say is learnt from the corpus itself, by grouped counts of
the languages that the texts alone suggest; hosts are smoothed by their domain, domains by
the corpus. A text's own guess is taken off these counts where they speak about it, so that
it does not count twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import key_text, stored, typed
from silostar.llm.minhash import mix

BITS = 14
# Labelled texts that the likelihoods are learnt from at most, and languages at most.
SAMPLE = 4000
MOST_LANGUAGES = 64
FIT_TASKS = 8  # each counts whole languages
# Pseudo-counts by which a host leans on its domain, a domain and a declaration on the corpus.
STRENGTH = 5.0
# Trigrams overlap: a text counts as half as many, and a long one as this many.
MOST_TRIGRAMS = 200
TRIGRAM_WEIGHT = 0.5
ACCEPT_FROM = 0.5


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # languages x buckets, log probabilities


def trigrams(text: str | None) -> tuple[np.ndarray, int]:
    """Buckets of the trigrams of a text's words, and its number of letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 0xC0)
    codes = np.where(letter, codes, 32).astype(np.uint64)
    keep = letter[:-2] | letter[1:-1] | letter[2:]
    keys = ((codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:])[keep]
    return (mix(keys) & np.uint64((1 << BITS) - 1)).astype(np.int64), int(letter.sum())


def fit(
    df: DataFrame, key: str, text: str, language: str, sample: int = SAMPLE,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Smoothed trigram probabilities of each language, from at most ``sample`` labelled
    rows: those whose keys have the lowest hashes; null languages and keys are left out.

    If the sample names more than ``most_languages``, the most frequent ones are learnt (the
    first by name of equally frequent ones); texts in another language then get the likest of
    these. The driver gets a table of counts for each.
    """
    chosen = (
        df.select(F.col(key).alias("key"), F.col(language).alias("language"))
        .filter(F.col("key").isNotNull() & F.col("language").isNotNull())
        .groupBy("key").agg(F.min("language").alias("language"))
        .orderBy(F.xxhash64("key"), "key").limit(sample)
    )
    learnt = (
        chosen.groupBy("language").count().orderBy(F.desc("count"), "language").limit(most_languages)
    )
    chosen = chosen.join(learnt.select("language"), "language", "left_semi")
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # A language is counted by one task, so the driver gets a table of counts for each.
    rows = texts.join(F.broadcast(chosen), "key").select("language", "text").repartition(FIT_TASKS, "language")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch["language"], batch["text"]):
                held = totals.setdefault(name, np.zeros(1 << BITS))
                held += np.bincount(trigrams(t)[0], minlength=1 << BITS)
        yield pd.DataFrame([(name, c.tobytes()) for name, c in totals.items()], columns=["language", "counts"])

    found = rows.mapInPandas(run, "language string, counts binary").toArrow().to_pylist()
    counts = {row["language"]: np.frombuffer(row["counts"]) for row in found}
    names = tuple(sorted(counts)) or ("und",)
    table = np.array([counts.get(name, np.zeros(1 << BITS)) for name in names]) + 0.05
    return Model(names, np.log(table / table.sum(1, keepdims=True)))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def suffix_of(url: Column) -> Column:
    """The last label of the host, and a first path segment of two letters."""
    label = F.regexp_extract(host_of(url), r"([^.]+)$", 1)
    segment = F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    return F.concat_ws("/", label, F.lower(segment))


def declared_in(html: Column) -> Column:
    found = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)
    return F.lower(F.nullif(found, F.lit("")))


def text_of(html: Column) -> Column:
    """Markup, scripts, styles and comments taken out; those that do not end go to the end."""
    return F.regexp_replace(
        html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^>]*>", " "
    )


def identify(
    df: DataFrame, model: Model, key: str, text: Column, declared: Column, host: Column, suffix: Column,
    accept_from: float = ACCEPT_FROM, strength: float = STRENGTH, most_trigrams: int = MOST_TRIGRAMS,
) -> DataFrame:
    """One row per row of ``df``: key, host, declared, text_language, language, posterior,
    accepted.

    A null or empty declaration or suffix says nothing; rows without a host share an unnamed
    one. A text without letters has no language and is not accepted, and neither is one whose
    best language stays below ``accept_from``. Ties go to the first language by name. Null
    keys and repeated rows pass through. A text's trigrams count by their mean, and a long
    text as ``most_trigrams`` of them, so that its length does not outweigh all else.
    """
    names, n = model.languages, len(model.languages)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = shared.value.weights
        for batch in batches:
            scores, best = [], []
            for t in batch.pop("text"):
                buckets, letters = trigrams(t)
                if not letters or not len(buckets):
                    scores.append(None)
                    best.append(-1)
                    continue
                mean = weights[:, buckets].mean(1)
                scores.append((mean * min(len(buckets), most_trigrams) * TRIGRAM_WEIGHT).tolist())
                best.append(int(mean.argmax()))
            yield batch.assign(scores=scores, best=best)

    blank = lambda c: F.coalesce(c, F.lit(""))
    rows = df.select(
        key_text(key), text.alias("text"), blank(declared).alias("declared"),
        blank(host).alias("host"), blank(suffix).alias("suffix"),
    )
    scored = typed(
        rows.mapInPandas(
            run, "key string, declared string, host string, suffix string, scores array<double>, best int"
        ).withColumn("domain", F.regexp_extract("host", r"([^.]+\.)?[^.]+$", 0)),
        df, key,
    )
    scored = stored(scored, "language-scores")
    heard = scored.filter(F.col("best") >= 0)
    counts = F.array(*(F.count_if(F.col("best") == i).cast("double") for i in range(n)))
    total = np.array(heard.agg(counts.alias("c")).first()["c"]) + 1.0
    everywhere = F.array(*(F.lit(float(x)) for x in total / total.sum()))
    flat = F.array(*(F.lit(0.0) for _ in range(n)))
    own = F.array(*((F.col("best") == i).cast("double") for i in range(n)))

    def by(column: str) -> DataFrame:
        return heard.groupBy(column).agg(counts.alias(f"by_{column}"))

    def smoothed(column: str, parent: Column) -> Column:
        """Shares of the languages among the other rows with this value, leaning on ``parent``."""
        others = F.zip_with(F.coalesce(f"by_{column}", flat), own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
        size = F.aggregate(others, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(others, parent, lambda c, p: (c + strength * p) / (size + strength))

    def says(column: str) -> Column:
        """How much more likely the value is under each language than in the corpus."""
        ratio = F.zip_with(smoothed(column, everywhere), everywhere, lambda p, q: F.log(p / q))
        return F.when(F.col(column) == "", flat).otherwise(ratio)

    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    prior = F.transform(smoothed("host", F.col("by_parent")), lambda p: F.log(p))
    fused = (
        scored.join(by("host"), "host", "left").join(by("domain"), "domain", "left")
        .join(by("declared"), "declared", "left").join(by("suffix"), "suffix", "left")
        .withColumn("by_parent", smoothed("domain", everywhere))
        .withColumn("sums", add(add(add(F.col("scores"), prior), says("declared")), says("suffix")))
        .withColumn("most", F.array_max("sums"))
    )
    spelled = F.array(*(F.lit(name) for name in names))
    name_at = lambda i: F.get(spelled, i)
    sum_ = F.aggregate("sums", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    return fused.select(
        F.col("key").alias(key), "host", F.nullif("declared", F.lit("")).alias("declared"),
        F.when(F.col("best") >= 0, name_at(F.col("best"))).alias("text_language"),
        name_at((F.array_position("sums", F.col("most")) - 1).cast("int")).alias("language"),
        (1 / sum_).alias("posterior"),
    ).withColumn("accepted", F.coalesce(F.col("posterior") >= accept_from, F.lit(False)))
