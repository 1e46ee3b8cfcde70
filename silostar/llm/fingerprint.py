"""Fingerprints of documents that add up: homomorphic multiset hashing.

A text is the multiset of its paragraphs: its lines, cut after the ends of sentences, so that
an edit inside a long line leaves the rest of it alone. Each paragraph is hashed to a wide
vector, and a fingerprint is the sum of the vectors, each entry modulo a power of two:

* one entry that counts paragraphs, modulo 2^60;
* ``WORDS`` entries with uniform values modulo 2^60, which tell different multisets apart;
* 120 counters of 20 bits, three to a number, each raised by a paragraph if one bit of its
  hash is set. Read as differences from half the count they are a random projection of the
  multiset, so that the cosine of two of them estimates that of the multisets (to about 0.09).

Equal texts have equal fingerprints, and so have texts of the same paragraphs in another
order. ``added`` and ``removed`` give the fingerprint of a text with paragraphs put in or
taken out from the fingerprints alone. DataFrame functions only.

Rows: null texts are empty; an empty text has no paragraph. Documents are ordered by id, null
ids first; rows that share an id are ordered by the hash of their text, and repeated rows
stay. The only columns read are the named ones, so any other may be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silostar.llm.common import stored

WORDS = 4  # numbers of 60 bits cut from a paragraph's SHA-256
COUNTED = 2  # of these give the bits of counters
SHIFTS = 20  # counters are 20 bits wide, so a number holds three
_FIELDS = (0, 20, 40)
_LOW = (1 << 60) - 1
_FIRST_BITS = sum(1 << f for f in _FIELDS)
_PARAGRAPH = r"[^\n.!?]*[.!?]+|[^\n.!?]+"

# Rows of a bucket of neighbouring ids, and the most buckets (edges are a literal of the plan).
BUCKET_ROWS = 4_096
MOST_BUCKETS = 32_768
_LEAST_ID = -(1 << 63)


def _sum(numbers: Column, term) -> Column:
    return F.aggregate(
        numbers, F.lit(0).cast("bigint"), lambda s, x: (s + term(x)).bitwiseAND(F.lit(_LOW))
    )


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column as ``name``, an array of numbers."""
    content = F.coalesce(F.col(text), F.lit(""))
    pieces = F.regexp_extract_all(content, F.lit(_PARAGRAPH), F.lit(0))
    paragraphs = F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != "")
    number = lambda h, k: F.conv(F.substring(h, 15 * k + 1, 15), 16, 10).cast("bigint")
    hashed = F.transform(
        F.transform(paragraphs, lambda p: F.sha2(p, 256)),
        lambda h: F.struct(*[number(h, k).alias(f"n{k}") for k in range(WORDS)]),
    )
    numbers = [f"{name}_{k}" for k in range(WORDS)]
    split = df.withColumn(name, hashed).withColumns(
        {n: F.col(name)[f"n{k}"] for k, n in enumerate(numbers)}
    )
    entries = [F.size(numbers[0]).cast("bigint")]
    entries += [_sum(F.col(n), lambda x: x) for n in numbers]
    entries += [
        _sum(F.col(n), lambda x, j=j: F.shiftright(x, j).bitwiseAND(F.lit(_FIRST_BITS)))
        for n in numbers[:COUNTED] for j in range(SHIFTS)
    ]
    return split.withColumn(name, F.array(*entries)).drop(*numbers)


def added(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_LOW)))


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of ``a`` without those of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_LOW)))


def counters(fingerprint: Column) -> Column:
    """The counters as twice their distance from half the number of paragraphs."""
    size, half = 1 << SHIFTS, 1 << (SHIFTS - 1)
    count = F.element_at(fingerprint, 1)
    packed = F.slice(fingerprint, WORDS + 2, COUNTED * SHIFTS)

    def one(x: Column, field: int) -> Column:
        bits = F.shiftright(x, field).bitwiseAND(F.lit(size - 1))
        return (bits * 2 - count + F.lit(half)).bitwiseAND(F.lit(size - 1)) - F.lit(half)

    return F.flatten(F.transform(packed, lambda x: F.array(*[one(x, f) for f in _FIELDS])))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0).cast("bigint"), lambda s, x: s + x).cast("double")


def likeness(a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
    """From 0 to 1, of fingerprints and their ``counters``: 1 if they are equal, else the
    cosine of the counters, 0 where it is negative or one of the texts is empty."""
    norms = _dot(of_a, of_a) * _dot(of_b, of_b)
    cosine = F.when(norms > 0, _dot(of_a, of_b) / F.sqrt(norms)).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def listed(fingerprint: Column) -> Column:
    """As hexadecimal text, 15 digits a number."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def _edges(keys: DataFrame) -> list[int]:
    """Ids that cut the table into buckets of about ``BUCKET_ROWS`` rows, ascending; an id
    with several buckets' worth of rows comes several times. At most ``MOST_BUCKETS``."""
    buckets = min(keys.count() // BUCKET_ROWS + 1, MOST_BUCKETS)
    if buckets == 1:
        return []
    parts = [k / buckets for k in range(1, buckets)]
    return keys.agg(F.percentile_approx("at", parts, max(10_000, 4 * buckets))).first()[0]


def _below(edges: list[int], at: Column, equal: bool) -> Column:
    """How many edges are less than ``at`` (or equal), by halving."""
    table = F.array(*[F.lit(e).cast("bigint") for e in edges])
    none = F.struct(F.lit(0).alias("low"), F.lit(len(edges)).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        edge = F.get(table, middle)
        less = (edge <= at) if equal else (edge < at)
        open_ = span["low"] < span["high"]
        return F.struct(
            F.when(open_ & less, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(open_ & ~less, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(edges).bit_length()))
    return F.aggregate(steps, none, halve)["low"]


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, ``text`` and ``fingerprint`` of every row, with ``next_text`` and
    ``next_fingerprint``: those of the next row in the order of the ids, or of the first row
    after the last one. Nulls are empty texts.

    The ids are cut into buckets at approximate quantiles, one shuffle brings the texts of a
    bucket together, and each bucket also gets the first row of the following one. An id
    with many rows is spread over several buckets by the hash of the text; rows that repeat
    a text and an id many times travel as one row with their number.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("bigint"), F.lit(_LEAST_ID)).alias("at"),
        F.shiftrightunsigned(F.xxhash64(content), 1).alias("hash"), content.alias("text"),
    )
    edges = _edges(rows.select("at"))
    if edges:
        low, high = _below(edges, F.col("at"), False), _below(edges, F.col("at"), True)
        within = F.floor(F.col("hash") / F.lit(float(1 << 63)) * (F.col("high") - F.col("low"))).cast("int")
        rows = rows.withColumns({"low": low, "high": high}).withColumn(
            "bucket", F.least(F.col("low") + within, F.greatest(F.col("high") - 1, F.col("low")))
        ).drop("low", "high")
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    rows = rows.withColumn("copies", F.lit(1).cast("bigint"))

    same = ["key", "hash"]
    often = rows.groupBy(*same).count().filter(F.col("count") > BUCKET_ROWS)
    often = stored(often.withColumnRenamed("count", "n"), "repeated-rows")
    if not often.isEmpty():
        a, b = rows.alias("a"), often.alias("b")
        on = F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.hash") == F.col("b.hash"))
        once = a.join(b, on).select("a.*", "n").dropDuplicates([*same, "text"])
        once = once.withColumn("copies", F.col("n")).drop("n")
        rows = a.join(b, on, "left_anti").unionByName(once)

    # The first row of each bucket, by small keys; then its text.
    least = rows.groupBy("bucket", "at").agg(F.min("hash").alias("hash"))
    least = least.groupBy("bucket").agg(F.min(F.struct("at", "hash")).alias("first"))
    least = stored(least.select("bucket", "first.at", "first.hash"), "first-keys")
    around = Window.orderBy("bucket")  # a row per bucket, MOST_BUCKETS at most
    before = F.coalesce(F.lag("bucket").over(around), F.max("bucket").over(Window.partitionBy()))
    firsts = rows.join(least, ["bucket", "at", "hash"], "left_semi").groupBy("bucket").agg(
        F.max("text").alias("text")
    )
    before = least.select("bucket", before.alias("before"))
    ends = firsts.join(before, "bucket").select(
        F.lit(None).cast(rows.schema["key"].dataType).alias("key"), F.lit(0).cast("bigint").alias("at"),
        F.lit(0).cast("bigint").alias("hash"), "text", F.col("before").cast("int").alias("bucket"),
        F.lit(0).cast("bigint").alias("copies"),
    )
    together = with_fingerprint(rows.unionByName(ends).repartition("bucket"), "text", "fingerprint")
    order = Window.partitionBy("bucket").orderBy((F.col("copies") == 0), "at", "hash")
    own = ("text", "fingerprint")
    following = {f"next_{c}": F.lead(c).over(order) for c in own}
    found = together.withColumns(following).filter("copies > 0").drop("at", "hash", "bucket")
    if often.isEmpty():
        return found.drop("copies")
    # All but the last of rows that repeat a text are followed by a copy of themselves.
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    inner = F.col("copy") < F.col("copies")
    return found.withColumn("copy", copy).select(
        "key", *own, *[F.when(inner, F.col(c)).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in own]
    )


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, n_chars, edited (the text with its last half replaced
    by as much of the start of the next text), the fingerprints of the text, of ``edited``
    and of the next text, and the likeness of the first to the others."""
    rows = with_next(df, key, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumns({"n_chars": n.cast("bigint"), "edited": edited}).drop("text", "next_text")
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    names = ("fingerprint", "edited_fingerprint", "next_fingerprint")
    of = {name: f"{name}_counters" for name in names}
    rows = rows.withColumns({c: counters(F.col(name)) for name, c in of.items()})

    def like(other: str) -> Column:
        a = "fingerprint"
        return likeness(F.col(a), F.col(other), F.col(of[a]), F.col(of[other]))

    return rows.select(
        F.col("key").alias(key), "n_chars", "edited", *names,
        like("edited_fingerprint").alias("near_edited"), like("next_fingerprint").alias("near_next"),
    )
