"""Versioned dimension history (SCD2): one open version per key, closed ones kept."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.functions.columns import attr_signature

# Fixed values
VALID_FROM, VALID_TO, CURRENT, SIGNATURE = (
    "vigente_desde", "vigente_hasta", "es_vigente", "attribute_signature",
)


def timestamp(ts: datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _open_versions(
    rows: DataFrame, keys: Sequence[str], attributes: Sequence[str], ts: datetime,
    extra: Sequence[str] = (),
) -> DataFrame:
    return rows.select(
        *keys,
        *attributes,
        *extra,
        attr_signature(attributes).alias(SIGNATURE),
        timestamp(ts).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(1).alias(CURRENT),
    )


def scd2_init(
    rows: DataFrame, keys: Sequence[str], attributes: Sequence[str], ts: datetime,
    extra: Sequence[str] = (),
) -> DataFrame:
    """First load: one open version per key. ``extra`` columns are kept but not compared."""
    return _open_versions(rows, keys, attributes, ts, extra)


def scd2_changes(
    history: DataFrame, incoming: DataFrame, keys: Sequence[str], attributes: Sequence[str],
    ts: datetime, extra: Sequence[str] = (),
) -> DataFrame:
    """The versions to open: keys without an open version, or whose attributes differ.

    The open versions are cut down to the incoming keys first, so a small batch costs one
    narrow scan of the history and no shuffle of it. A signature difference counts even
    when every single attribute has the same text, so the same batch twice opens nothing.
    """
    keys = list(keys)
    versions = _open_versions(incoming, keys, attributes, ts, extra)
    current = (
        history.filter(F.col(CURRENT) == 1)
        .select(*keys, F.col(SIGNATURE).alias("_old"))
        .join(versions.select(*keys), keys, "left_semi")
    )
    return (
        versions.join(current, keys, "left")
        .filter(F.col("_old").isNull() | (F.col("_old") != F.col(SIGNATURE)))
        .drop("_old")
    )


def scd2_closed(
    current: DataFrame, opened: DataFrame, keys: Sequence[str], ts: datetime
) -> DataFrame:
    """The open versions that ``opened`` replaces, closed."""
    closing = {VALID_TO: timestamp(ts), CURRENT: F.lit(0)}
    return current.join(opened.select(*keys), list(keys), "left_semi").select(
        *[closing[c].alias(c) if c in closing else F.col(c) for c in current.columns]
    )


def scd2_open(current: DataFrame, opened: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The open versions after ``opened`` has replaced some and added others."""
    kept = current.join(opened.select(*keys), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(opened, allowMissingColumns=True)


def scd2_apply(
    history: DataFrame, incoming: DataFrame, keys: Sequence[str], attributes: Sequence[str],
    ts: datetime, extra: Sequence[str] = (),
) -> DataFrame:
    """The whole history after a batch (one row per key in ``incoming``). A warehouse that
    keeps open and closed versions apart writes the former and appends the newly closed."""
    opened = scd2_changes(history, incoming, keys, attributes, ts, extra)
    current, past = history.filter(F.col(CURRENT) == 1), history.filter(F.col(CURRENT) != 1)
    closed = scd2_closed(current, opened, keys, ts)
    return past.unionByName(closed).unionByName(
        scd2_open(current, opened, keys), allowMissingColumns=True
    )
