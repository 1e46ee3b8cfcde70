from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silostar.functions import columns as fx
from silostar.functions import display


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_line_amounts(frame):
    df = frame("g decimal(12,4), d decimal(8,6)", (Decimal("10.00"), Decimal("0.25")), (Decimal("10"), None))
    strict = df.select(*fx.line_amounts("g", "d", null_discount=0)).collect()
    assert [tuple(map(float, r)) for r in strict] == [(10, 2.5, 7.5), (10, 0, 10)]
    lenient = df.select(*fx.line_amounts("g", "d")).collect()
    assert [r.net_amount for r in lenient] == [Decimal("7.5"), None]


def test_full_name_keeps_null(frame):
    df = frame("a string, b string", ("Ana", "Paz"), ("Ana", None))
    assert values(df, fx.full_name("a", "b")) == ["Ana Paz", None]


def test_stock_alarm(frame):
    df = frame("s int, r int", (None, 5), (0, 5), (-1, 5), (5, 5), (6, 5), (3, None), (None, None))
    assert values(df, fx.stock_alarm("s", "r")) == [2, 2, 2, 1, 0, 0, 2]


def test_segments(frame):
    df = frame("s int", (None,), (0,), (1,), (2,), (3,), (4,), (5,))
    names = ["sin_score", "bajo_0_1", "bajo_0_1", "medio_2_3", "medio_2_3", "alto_4_5", "alto_4_5"]
    assert values(df, fx.score_segment("s")) == names
    assert values(df, fx.score_segment_order("s")) == [4, 3, 3, 2, 2, 1, 1]
    labelled = df.select(fx.score_segment("s").alias("x"))
    assert values(labelled, fx.segment_label("x"))[0] == "Sin score"
    assert values(labelled.select(F.lit("other").alias("x")), fx.segment_label("x"))[0] == "other"


def test_geo_signature(frame):
    df = frame(
        "c string, r string, t string, p string",
        ("UK", None, "London", "WA1"), (" UK ", "", " London", "WA1"), ("", " ", None, None),
    )
    got = values(df, fx.geo_signature("c", "r", "t", "p"))
    assert got == ["UK|<none>|London|WA1"] * 2 + ["<unknown>|<none>|<none>|<none>"]
    assert values(df, fx.geo_signature("c", "r", "t"))[0] == "UK|<none>|London|<none>"


def test_attr_signature(frame):
    df = frame("a string, b int", ("x", 1), (None, None), ("", None))
    assert values(df, fx.attr_signature(["a", "b"])) == ["x|1", "|", "|"]


def test_dates(frame):
    df = frame("d date", (date(1996, 7, 4),))
    assert tuple(df.select(*fx.date_attributes("d")).first()) == (19960704, date(1996, 7, 4), 1996, 3, 7, 4)
    assert values(df, fx.period(F.year("d"), F.month("d"))) == ["1996-07"]


@pytest.mark.parametrize(
    "pattern, good, bad",
    [
        (fx.INTEGER_PATTERN, ["12", "0"], ["-1", "", "12\n", "1.0", " 1"]),
        (fx.NUMERIC_PATTERN, ["12", "1.5"], ["1.", "", "-1.5", "1.5\n", ".5"]),
        (
            fx.TIMESTAMP_PATTERN,
            ["1996-07-04 00:00:00.000"],
            ["1996-07-04 00:00:00", "1996-07-04", "", "1996-07-04 00:00:00.000\n"],
        ),
    ],
)
def test_patterns(frame, pattern, good, bad):
    df = frame("v string", *[(v,) for v in [*good, *bad, None]])
    assert values(df, fx.not_matches("v", pattern)) == [False] * len(good) + [True] * len(bad) + [False]


def test_display(frame):
    df = frame(
        "n decimal(12,4), t timestamp_ntz",
        (Decimal("1234567.5"), datetime(2024, 1, 2, 3, 4, 5)),
        (None, datetime(2024, 1, 2, 3, 4, 5, 100000)),
        (Decimal("-5"), None),
    )
    assert values(df, display.display_number(F.col("n"))) == ["1,234,567.50", "", "-5.00"]
    assert values(df, display.display_currency(F.col("n"))) == ["$1,234,567.50", "$0.00", "$-5.00"]
    assert values(df, display.display_time(F.col("t"))) == [
        "2024-01-02 03:04:05", "2024-01-02 03:04:05.100000", "",
    ]
