"""Business column expressions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
INTEGER_PATTERN = r"\A\d+\z"
NUMERIC_PATTERN = r"\A\d+(\.\d+)?\z"
TIMESTAMP_PATTERN = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}\z"

UNKNOWN_COUNTRY = "<unknown>"
NO_VALUE = "<none>"
NO_COUNTRY = "<sin_pais>"

SEGMENT_HIGH = "alto_4_5"
SEGMENT_MEDIUM = "medio_2_3"
SEGMENT_LOW = "bajo_0_1"
SEGMENT_NONE = "sin_score"

SEGMENT_LABELS = {  # in the order of the segments
    SEGMENT_HIGH: "Alto (4-5)",
    SEGMENT_MEDIUM: "Medio (2-3)",
    SEGMENT_LOW: "Bajo (0-1)",
    SEGMENT_NONE: "Sin score",
}
# ----------------------------------------------------------------------------

__all__ = [
    "attr_signature",
    "blank_to_null",
    "date_attributes",
    "date_key",
    "full_name",
    "geo_signature",
    "line_amounts",
    "not_matches",
    "period",
    "score_segment",
    "score_segment_order",
    "segment_label",
    "segment_of",
    "stock_alarm",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces; a blank becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def not_matches(c: Column | str, pattern: str) -> Column:
    """Non-null and outside the pattern. Patterns are anchored with \\A and \\z because
    Java's ``$`` also accepts a trailing newline."""
    c = _col(c)
    return c.isNotNull() & ~c.rlike(pattern)


def line_amounts(
    gross: Column | str, discount: Column | str, null_discount: int | None = None
) -> list[Column]:
    """Gross, discount and net amount of a line.

    ``null_discount=0`` is the initial-load rule (a missing discount counts as 0);
    without it a missing discount leaves the two derived amounts null (delta rule).
    """
    gross, discount = _col(gross), _col(discount)
    if null_discount is not None:
        discount = F.coalesce(discount, F.lit(null_discount))
    return [
        gross.alias("gross_amount"),
        (gross * discount).alias("discount_amount"),
        (gross * (F.lit(1) - discount)).alias("net_amount"),
    ]


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; null if either is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def stock_alarm(stock: Column | str, reorder: Column | str) -> Column:
    """2 = out of stock (or unknown), 1 = at or under the reorder level, 0 = normal."""
    stock = F.coalesce(_col(stock), F.lit(0))
    reorder = F.coalesce(_col(reorder), F.lit(0))
    return F.when(stock <= 0, 2).when(stock <= reorder, 1).otherwise(0)


def score_segment_order(score: Column | str) -> Column:
    """Rank of the segment of a score: 1 high, 2 medium, 3 low, 4 no score."""
    score = _col(score)
    return F.when(score >= 4, 1).when(score >= 2, 2).when(score.isNotNull(), 3).otherwise(4)


def segment_of(order: Column | str) -> Column:
    """Segment by its rank."""
    return F.element_at(F.array(*[F.lit(s) for s in SEGMENT_LABELS]), _col(order))


def score_segment(score: Column | str) -> Column:
    return segment_of(score_segment_order(score))


def segment_label(segment: Column | str) -> Column:
    """Display label of a segment; an unknown segment passes through."""
    segment = _col(segment)
    label = segment
    for code, text in SEGMENT_LABELS.items():
        label = F.when(segment == code, text).otherwise(label)
    return label


def geo_signature(
    country: Column | str,
    region: Column | str,
    city: Column | str,
    postal_code: Column | str | None = None,
) -> Column:
    """Natural key of a place. Pass no postal code where the source has none."""
    parts = [F.coalesce(blank_to_null(country), F.lit(UNKNOWN_COUNTRY))]
    parts += [F.coalesce(blank_to_null(c), F.lit(NO_VALUE)) for c in (region, city)]
    if postal_code is None:
        parts.append(F.lit(NO_VALUE))
    else:
        parts.append(F.coalesce(blank_to_null(postal_code), F.lit(NO_VALUE)))
    return F.concat_ws("|", *parts)


def attr_signature(columns: Sequence[str]) -> Column:
    """One text per version of a dimension row; null and blank compare equal."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def date_key(day: Column | str) -> Column:
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_attributes(day: Column | str) -> list[Column]:
    day = _col(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.dayofmonth(day).alias("day_number"),
    ]


def period(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM``."""
    return F.concat(
        _col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0")
    )
