"""Secrets in texts, told apart by who uses them across the corpus.

Candidates are found by patterns and known by the hash of their value. For each hash the
distinct owners and repositories are counted over the whole corpus: a value that many owners
share is a copied example, one that a single owner uses looks live. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import stored

# kind: (pattern, group with the value, fewest characters of the value). In this order.
BASE = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # a run of 24 or more is a whole run of [0-9a-f]+
}
# The method's own kind: a long run of key characters with letters and digits.
GENERIC = {
    "generic": (
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20,
    )
}
# From so many distinct owners on, a value counts as a widely copied example.
COPIED_OWNERS = 3
MASK = "[SECRET]"
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,hash:string>>"


def _found(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Leftmost matches that do not overlap, with code point positions.

    Splitting by the pattern gives the text between matches, so that their lengths add up to
    the positions. Texts without a match are not split.
    """
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        value = F.regexp_extract(pair["value"], pattern, group)
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            (start + F.length(pair["value"])).alias("end"), F.sha2(value, 256).alias("hash"),
        )
        keeps = F.length(value) >= least
        return F.struct(
            (start + F.coalesce(F.length(pair["value"]), F.lit(0))).alias("at"),
            F.when(keeps, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    spans = F.aggregate(pairs, zero, step)["spans"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def candidates(df: DataFrame, key: str, text: str, repository: Column, owner: Column) -> DataFrame:
    """One row per row of ``df``: key, a hash of the text, repository, owner, ``base`` and
    ``generic`` spans. Generic spans that overlap a base span are left out."""
    content = F.coalesce(F.col(text), F.lit(""))
    base = [_found(F.col("content"), k, r, *p) for r, (k, p) in enumerate(BASE.items())]
    ((kind, pattern),) = GENERIC.items()
    generic = _found(F.col("content"), kind, len(BASE), *pattern)

    def free(span: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    return (
        df.select(
            F.col(key).alias("key"), content.alias("content"),
            F.coalesce(repository, F.lit("")).alias("repository"),
            F.coalesce(owner, F.lit("")).alias("owner"),
        )
        .select("*", F.array_sort(F.concat(*base)).alias("base"), generic.alias("generic"))
        .select(
            "key", F.xxhash64("content").alias("text_hash"), "repository", "owner", "base",
            F.when(F.size("generic") == 0, F.col("generic")).otherwise(F.filter("generic", free)).alias("generic"),
        )
    )


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories. Rows of one owner and repository are one before they
    move, so that a value copied everywhere moves as a row per task, owner and repository."""
    return (
        found.select("owner", "repository", F.explode(F.concat("base", "generic")).alias("s"))
        .select(F.col("s.hash").alias("hash"), "owner", "repository")
        .distinct()
        .groupBy("hash")
        .agg(F.countDistinct("owner").alias("n_owners"), F.count(F.lit(1)).alias("n_repositories"))
    )


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", repository: Column | None = None,
    owner: Column | None = None, copied_owners: int = COPIED_OWNERS,
) -> DataFrame:
    """One row per row of ``df``: key, text_hash, ``base`` spans and ``spans``, arrays of
    (start, rank, kind, end, hash, n_owners, n_repositories, live) by start and kind.

    ``spans`` are the base spans and the generic ones that one owner alone uses. ``live`` is
    false from ``copied_owners`` owners on. Null texts are empty, null owners and
    repositories are one unnamed owner or repository. Rows that agree in key and text have
    the same spans and are looked up once; null keys are a key of their own.
    """
    found = stored(
        candidates(
            df, key, text,
            F.col("source") if repository is None else repository,
            F.col("source") if owner is None else owner,
        ),
        "secret-candidates",
    )
    each = (
        found.filter(F.size("base") + F.size("generic") > 0)
        .select("key", "text_hash", F.explode(F.concat("base", "generic")).alias("s"))
        .distinct()
        .select("key", "text_hash", "s", F.col("s.hash").alias("hash"))
    )
    judged = (
        each.join(ownership(found), "hash")
        .filter((F.col("s.rank") < len(BASE)) | (F.col("n_owners") == 1))
        .groupBy("key", "text_hash")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "s.*", "n_owners", "n_repositories",
                        (F.col("n_owners") < copied_owners).alias("live"),
                    )
                )
            ).alias("spans")
        )
    )
    kind = judged.schema["spans"].dataType.simpleString()
    a, b = found.alias("a"), judged.alias("b")
    return a.join(
        b, F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.text_hash") == F.col("b.text_hash")), "left"
    ).select(
        F.col("a.key").alias(key), "a.text_hash", "a.base",
        F.coalesce("b.spans", F.array().cast(kind)).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each live span replaced; spans that overlap become one mask."""

    def step(done: Column, s: Column) -> Column:
        apart = s["start"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(done["out"], gap, F.lit(MASK))).otherwise(done["out"]).alias("out"),
        )

    live = F.filter(spans, lambda s: s["live"])
    done = F.aggregate(live, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(F.size(live) == 0, text).otherwise(F.concat(done["out"], rest))
