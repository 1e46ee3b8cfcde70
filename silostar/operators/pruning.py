"""Key ranges of a batch, to be pushed into the scan of a large table.

A table whose files are laid out by ranges of a key has narrow minima and maxima per file and
row group, so a filter on the ranges that a batch touches skips the others. The ranges are
only a first cut: they hold every key of the batch, and other keys too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_RANGES = 32  # parts of a pushed filter; what bounds the rows that come to the driver

Ranges = Sequence[tuple[object, object]]


def key_ranges(batch: DataFrame, column: str, most: int = MOST_RANGES) -> Ranges:
    """At most ``most`` ranges (lowest, highest) that hold every key of ``batch``.

    The span of the keys is cut into equal cells and each cell is narrowed to the keys in it,
    so that a few old keys among many new ones do not open the span between them. A key that
    is not a whole number has one range. Nulls have none. ``batch`` is read twice.
    """
    keys = batch.select(F.col(column).alias("key"))
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    if not isinstance(batch.schema[column].dataType, T.IntegralType):
        return [(low, high)]
    width = (high - low) // most + 1
    # In decimals: the span may not fit a long.
    cell = F.floor((F.col("key").cast("decimal(38,0)") - F.lit(low)) / F.lit(width))
    found = keys.filter(F.col("key").isNotNull()).groupBy(cell.alias("cell")).agg(
        F.min("key").alias("low"), F.max("key").alias("high")
    )
    return sorted((r.low, r.high) for r in found.collect())


def within(column: str, ranges: Ranges) -> Column:
    """The key is in one of the ranges: comparisons with literals, which reach the scan."""
    parts = [F.col(column).between(F.lit(low), F.lit(high)) for low, high in ranges]
    return reduce(or_, parts) if parts else F.lit(False)
