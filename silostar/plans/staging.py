"""Raw text to typed staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _exact_cast(c: str, to: str) -> Column:
    """Cast that raises on text outside the type, and on digits the type cannot hold,
    whatever the session's ANSI setting."""
    value = F.col(c)
    cast = value.try_cast(to)
    lost = value.isNotNull() & cast.isNull()
    if to.startswith("decimal"):
        lost = lost | (value.try_cast("decimal(38,18)") != cast)
    message = F.concat(F.lit(f"{c}: cannot become {to}: "), value)
    return F.when(lost, F.raise_error(message).cast(to)).otherwise(cast).alias(c)


def to_typed(df: DataFrame, type_map: Mapping[str, str]) -> DataFrame:
    """Project the listed columns to their types; columns not listed are dropped."""
    return df.select(
        *[F.col(c) if t == "string" else _exact_cast(c, t) for c, t in type_map.items()]
    )
