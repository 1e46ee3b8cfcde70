"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.operators.history import timestamp


def _row(
    table: str, column: str | None, step: str, batch_ts: datetime, total: Column,
    nulls: Column, distinct: Column, low: Column, high: Column, note: str | None,
) -> list[Column]:
    return [
        F.lit(table).alias("tabla"),
        F.lit(column).cast("string").alias("columna"),
        F.lit(step).alias("nombre_script"),
        timestamp(batch_ts).alias("fecha"),
        total.cast("bigint").alias("total_filas"),
        nulls.cast("bigint").alias("nulos"),
        distinct.cast("bigint").alias("valores_distintos"),
        low.cast("string").alias("valor_minimo"),
        high.cast("string").alias("valor_maximo"),
        F.lit(0).cast("bigint").alias("outliers_detectados"),
        F.lit(note).cast("string").alias("observaciones"),
    ]


# Columns of one type that are counted in one pass.
COLUMNS_PER_PASS = 4


def _distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The exact number of distinct values of each column. Columns of the same type go in a
    pass together, as pairs of column and value that are combined before the shuffle, so that
    a frequent value crosses as one row per task."""
    by_type: dict[str, list[int]] = {}
    for i, c in enumerate(columns):
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(i)
    parts = []
    for same in by_type.values():
        for at in range(0, len(same), COLUMNS_PER_PASS):
            some = same[at : at + COLUMNS_PER_PASS]
            pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(columns[i]).alias("value")) for i in some])
            counted = df.select(F.inline(pairs)).groupBy("i", "value").agg(F.lit(1).alias("n"))
            parts.append(counted.groupBy("i").agg(F.count("value").alias("distinct")))
    return reduce(DataFrame.unionByName, parts)


def profile(
    df: DataFrame, table: str, columns: Sequence[str], batch_ts: datetime, step: str,
    table_row: bool = False, approx: bool = False, note: str | None = None,
) -> DataFrame:
    """Total, nulls, distinct values, lowest and highest value of every column.

    ``approx=True`` estimates the distinct values and needs a single scan without a shuffle.
    ``table_row`` adds a row for the table itself. Lowest and highest text are binary.
    """
    aggregates, rows = [F.count("*").alias("total")], []
    for i, c in enumerate(columns):
        distinct = F.approx_count_distinct(c) if approx else F.lit(None).cast("bigint")
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"n{i}"), distinct.alias(f"d{i}"),
            F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"),
        ]
        figures = [F.col("total"), *(F.col(f"{k}{i}") for k in "ndlh")]
        rows.append(F.struct(F.lit(i).alias("i"), *_row(table, c, step, batch_ts, *figures, note)))
    if table_row:
        none = F.lit(None)
        figures = [F.col("total"), none, none, none, none]
        rows.append(F.struct(F.lit(-1).alias("i"), *_row(table, None, step, batch_ts, *figures, note)))
    # All figures but exact distinct values come from one scan.
    found = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if approx or not columns:
        return found.drop("i")
    names = [c for c in found.columns if c != "i"]
    counted = found.unionByName(_distinct(df, columns), allowMissingColumns=True)
    rows_ = counted.groupBy("i").agg(*[F.max(c).alias(c) for c in (*names, "distinct")])
    distinct = F.when(F.col("i") >= 0, F.coalesce("distinct", F.lit(0)))  # no row, no value
    return rows_.withColumn("valores_distintos", distinct).select(*names)


# Mergeable profiles ----------------------------------------------------------
PARTIAL_TYPES = (
    "columna string, total bigint, nulos bigint, dibujo binary, minimo string, maximo string"
)
# 2^12 registers: the estimate of distinct values has a relative standard error of about
# 1.04 / sqrt(2^12), 1.6 %; up to a few hundred values it is exact.
SKETCH_BITS = 12
_SKETCHED = ("int", "bigint", "string", "binary")


def partial_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a part of a table adds to its profile: a row per column, from one scan without a
    shuffle of rows. Distinct values are in a sketch, so that parts can be merged."""
    aggregates, rows = [F.count("*").alias("total")], []
    for i, c in enumerate(columns):
        own = df.schema[c].dataType.simpleString()
        value = F.col(c) if own in _SKETCHED else F.col(c).cast("string")
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"n{i}"),
            F.hll_sketch_agg(value, SKETCH_BITS).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"h{i}"),
        ]
        rows.append(F.struct(
            F.lit(c).alias("columna"), F.col("total").alias("total"), F.col(f"n{i}").alias("nulos"),
            F.col(f"d{i}").alias("dibujo"), F.col(f"l{i}").alias("minimo"), F.col(f"h{i}").alias("maximo"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def merged_profile(
    partials: DataFrame, df: DataFrame, table: str, columns: Sequence[str], batch_ts: datetime, step: str,
    table_row: bool = False, note: str | None = None,
) -> DataFrame:
    """The profile of a table from the partial profiles of its parts (of ``df`` only the
    types are used). Counts, nulls, lowest and highest values are exact; distinct values are
    estimated. Lowest and highest values were stored as text and compare in their own type."""
    figures, rows = [], []
    for i, c in enumerate(columns):
        own = F.col("columna") == c
        kind = df.schema[c].dataType
        figures += [
            F.coalesce(F.sum(F.when(own, F.col("total"))), F.lit(0)).alias(f"t{i}"),
            F.coalesce(F.sum(F.when(own, F.col("nulos"))), F.lit(0)).alias(f"n{i}"),
            F.hll_union_agg(F.when(own, F.col("dibujo"))).alias(f"d{i}"),
            F.min(F.when(own, F.col("minimo").cast(kind))).alias(f"l{i}"),
            F.max(F.when(own, F.col("maximo").cast(kind))).alias(f"h{i}"),
        ]
        distinct = F.coalesce(F.hll_sketch_estimate(f"d{i}"), F.lit(0))
        values = [F.col(f"t{i}"), F.col(f"n{i}"), distinct, F.col(f"l{i}"), F.col(f"h{i}")]
        rows.append(F.struct(*_row(table, c, step, batch_ts, *values, note)))
    if table_row:
        none = F.lit(None)
        rows.append(F.struct(*_row(table, None, step, batch_ts, F.col("t0"), none, none, none, none, note)))
    return partials.agg(*figures).select(F.inline(F.array(*rows)))
