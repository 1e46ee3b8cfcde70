"""From documents to training sequences, a stage at a time.

Each stage works on all that its predecessor kept and returns the columns of documents; the
last one returns the pieces of the packed sequences. Documents may have more columns than the
stages read, of any name.

Rows are told apart by their id and their text: rows that share an id may hold different texts,
and are different documents. Null ids are documents too, and go after all others where the
smallest id counts. Null texts are empty. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silostar import session
from silostar.llm import langid, minhash, packing, quality, secret_scan
from silostar.llm.common import discard, free_name, small_batches, stored, table


def _ready(spark: SparkSession) -> SparkSession:
    return small_batches(session.configure(spark))


def _identity() -> Column:
    """Text that tells rows apart by id and text, and sorts as the ids do: the id counted from
    the lowest long, in 20 digits (a tilde for null, which comes last), and the text's hash."""
    low = F.lit(str(1 << 63)).cast("decimal(20,0)")
    number = (F.col("doc_id").cast("decimal(20,0)") + low).cast("decimal(20,0)").cast("string")
    name = F.coalesce(F.lpad(number, 20, "0"), F.lit("~"))
    return F.concat_ws(":", name, F.sha2(F.coalesce("text", F.lit("")), 256))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the model go on, as they are. A null or empty
    text has too few words and goes; repeated rows go or stay together."""
    labels = table(_ready(spark), sf_dir, "labels")
    return quality.filter_rows(docs, quality.fit(docs, labels))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go. Their declared language is ``lang``, their
    host ``source``; they have no address. Null and empty texts have no language. Repeated
    rows are votes of their own; they go or stay together."""
    _ready(spark)
    row = free_name(docs, "row")
    named = docs.withColumn(row, _identity())
    model = langid.fit(docs, "doc_id", "text", "lang")
    found = langid.identify(
        named, model, row, F.col("text"), F.col("lang"), F.col("source"), F.lit(None).cast("string")
    )
    # Written first: the planner then knows their size, and does not move the texts if they
    # are few.
    gone = stored(found.filter(~F.col("accepted")).select(row).distinct(), "no-language")
    return named.join(gone, row, "left_anti").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id, and of
    several texts with this id that with the smallest hash. Of rows that repeat id and text
    one stays, the least by its other columns. Texts without words are no duplicates of each
    other; repeated rows of one are."""
    _ready(spark)
    row = free_name(docs, "row")
    named = docs.withColumn(row, _identity())
    found = minhash.duplicates(named, key=row, width=5, similarity=0.8)
    gone = stored(found.filter(~F.col("kept")).select(row).distinct(), "duplicate-rows")
    again = found.filter("kept").groupBy(row).count().filter("count > 1")
    again = stored(again.select(row), "repeated-rows")
    discard(found)
    kept = named.join(gone, row, "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(again, row, "left_anti")
    some = kept.join(again, row, "left_semi")
    least = some.groupBy(row).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("least"))
    return once.select(docs.columns).unionByName(least.select("least.*"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked in the texts; all documents go on, repeated rows
    too. ``n_chars`` follows the masked text, and null texts stay null."""
    _ready(spark)
    found = secret_scan.scan(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    live = found.filter(F.exists("spans", lambda s: s["live"])).select("doc_id", "text_hash", "spans")
    live = stored(live.dropDuplicates(["doc_id", "text_hash"]), "live-secrets")
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id"))
    same = same & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("l.text_hash"))
    joined = docs.alias("d").join(live.alias("l"), same, "left")
    spans, text = F.col("l.spans"), F.col("d.text")
    masked = F.when(spans.isNull(), text).otherwise(secret_scan.masked(text, spans))
    changed = {"text": masked, "n_chars": F.when(spans.isNull(), F.col("d.n_chars")).otherwise(F.length(masked))}
    return joined.select(*(
        changed.get(f.name, F.col(f"d.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema
    ))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as sequences of token ids. A null or empty text is its end alone;
    repeated rows are documents of their own."""
    _ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("packing", pack),
]
ORACLE_SQL = None  # a trained model decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
