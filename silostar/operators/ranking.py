"""First row per key and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order`` (which should leave no ties).

    Spark prunes to one row per key inside each map task before the shuffle
    (WindowGroupLimit), so a key that holds much of the data does not pile up in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest(
    df: DataFrame,
    keys: Sequence[str] = ("tabla", "columna", "tipo_chequeo"),
    time: str = "fecha",
    tie_break: str = "id",
) -> DataFrame:
    """The most recent row of every key; a null key is one key."""
    return first_per_key(df, keys, [F.desc_nulls_first(time), F.desc_nulls_first(tie_break)])


def top_per_key(df: DataFrame, keys: Sequence[str], value: str, *more: Column) -> DataFrame:
    """The row with the highest value of every key."""
    return first_per_key(df, keys, [F.desc(value), *more])


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows under ``order`` (a top-k report; planned as TakeOrdered)."""
    return df.orderBy(*order).limit(n)
