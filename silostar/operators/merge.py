"""Set-based maintenance of keyed tables. Each function returns the new content of a table;
`silostar.sources.tables` writes it as a new snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.operators.pruning import Ranges, within
from silostar.operators.ranking import first_per_key


def not_present(
    new: DataFrame, target: DataFrame, keys: Sequence[str],
    ranges: Mapping[str, Ranges] | None = None,
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target``.

    The target is first cut down to the keys that occur in ``new``. With a batch small
    enough for Spark to broadcast, the large target is scanned for its key columns only
    and is never shuffled. ``ranges`` of key columns, as ``pruning.key_ranges`` gives them for
    the batch, are pushed into that scan: of a target laid out by one of these columns only
    the row groups are read that may hold a key of the batch.
    """
    keys = list(keys)
    for column, held in (ranges or {}).items():
        target = target.filter(within(column, held))
    wanted = new.select(*keys).distinct()
    known = target.select(*keys).join(wanted, keys, "left_semi").distinct()
    return new.join(known, keys, "left_anti")


def insert_new(
    new: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
    ranges: Mapping[str, Ranges] | None = None,
) -> DataFrame:
    """Rows to append so that existing keys win and each new key comes in once.

    ``order`` decides which of several new rows with one key is kept; without it the
    smallest under all columns is. ``ranges`` are those of ``not_present``.
    """
    order = list(order) or [F.col(c) for c in new.columns if c not in keys]
    fresh = not_present(new, target, keys, ranges)
    if not order:
        return fresh.dropDuplicates(list(keys))
    return first_per_key(fresh, keys, order)


def _marked(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    renamed = [F.col(c).alias(f"_new_{c}") for c in columns]
    return rows.select(*keys, *renamed, F.lit(True).alias("_matched"))


def _overwritten(c: str) -> Column:
    return F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)


def scd1_update(
    dim: DataFrame, changed: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of matching rows, also with nulls; unknown keys are ignored."""
    joined = dim.join(_marked(changed, keys, columns), list(keys), "left")
    return joined.select(*[_overwritten(c) if c in columns else F.col(c) for c in dim.columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of existing keys and add the keys that are new."""
    added = not_present(source, target, keys)
    return scd1_update(target, source, keys, columns).unionByName(
        added.select(*target.columns), allowMissingColumns=True
    )


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are missing, as nulls."""
    missing = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def or_default(df: DataFrame, default: DataFrame) -> DataFrame:
    """``df``, or the literal ``default`` rows when ``df`` is empty."""
    return df.unionByName(default.where(~df.exists()))
