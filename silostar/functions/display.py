"""Text forms used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["display_currency", "display_number", "display_time"]


def display_number(c: Column) -> Column:
    """Thousands separators and two decimals; null shows as blank."""
    return F.coalesce(F.format_number(c, 2), F.lit(""))


def display_currency(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.coalesce(c, F.lit(0)), 2))


def display_time(c: Column) -> Column:
    """ISO time; six digits of fraction, only when there is one."""
    text = c.cast("string")
    return F.coalesce(
        F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text), F.lit("")
    )
