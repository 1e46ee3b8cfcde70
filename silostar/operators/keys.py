"""Surrogate keys without an identity column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def assign_keys(
    new: DataFrame,
    natural_key: Sequence[str],
    key: str,
    existing: DataFrame | int | None = None,
    bucket_digits: int = 3,
    dense: bool = True,
) -> DataFrame:
    """Number new rows after the highest key already given out: that of the table
    ``existing``, or the number itself where it is known.

    Rows are put in 16**bucket_digits buckets by the hash of their natural key and numbered
    inside each bucket, so no task sees more than a bucket. The buckets are even because
    natural keys are unique, and the numbers depend on the values alone, so a task that runs
    again gives the same ones.

    ``dense`` numbers have no gaps: each bucket is shifted by the rows in the buckets before
    it, which takes a count of ``new`` first. Without it the buckets interleave (bucket b
    gives b, b + n, b + 2n, ...), ``new`` is evaluated once, and there may be gaps; use this
    for large or costly frames.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key])
    bucketed = new.withColumn("_bucket", F.substring(F.md5(text), 1, bucket_digits))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural_key))
    placed = bucketed.withColumn("_place", place.cast("bigint"))

    last = F.lit(0).cast("bigint")
    if isinstance(existing, int):
        last = F.lit(existing).cast("bigint")
    elif existing is not None:
        last = F.coalesce(existing.select(F.max(key)).scalar(), last)
    if dense:
        placed = placed.join(F.broadcast(_offsets(bucketed)), "_bucket")
        number = last + F.col("_offset") + F.col("_place")
    else:
        number = _interleaved(last, 16**bucket_digits)
    return placed.select(number.cast("bigint").alias(key), *new.columns)


def _offsets(bucketed: DataFrame) -> DataFrame:
    """Rows before each bucket: at most 16**bucket_digits rows, which is what bounds the
    one-task window and the broadcast."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    return sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )


def _interleaved(last: Column, buckets: int) -> Column:
    start = last + F.pmod(F.negate(last), F.lit(buckets))  # next multiple of the buckets
    bucket = F.conv("_bucket", 16, 10).cast("bigint")
    return start + (F.col("_place") - 1) * buckets + bucket + 1
