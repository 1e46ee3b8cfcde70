"""What one task holds must not grow with the table."""

import re
from collections import Counter
from datetime import datetime

import pytest

from silostar.operators import checks as ck
from silostar.operators import increments
from silostar.workload.inputs import SCHEMAS
from silostar.workload.queries import QUERIES

GRAIN = ck.Rule(ck.FACT_GRAIN, "t", ("a", "b"))


@pytest.fixture
def large_tables(spark):
    """Plan as for tables that are too large to broadcast."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for setting in settings:
        spark.conf.set(setting, "-1")
    yield spark
    for setting in settings:
        spark.conf.unset(setting)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_by(text: str, *columns: str) -> list[int]:
    """Tasks of the exchanges that were asked for, by these columns."""
    keys = ", ".join(rf"{c}#\d+L?" for c in columns)
    return [int(n) for n in re.findall(rf"hashpartitioning\({keys}, (\d+)\), REPARTITION_BY_NUM", text)]


def test_tasks_of_the_grain_of_a_load_follow_the_rows(large_tables, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(ck, "ROWS_A_TASK", 100, raising=False)
    pairs = [(k % 150, k % 40) for k in range(900)] + [(7, 7)] * 60 + [(None, 1)] * 20 + [(3, None)] * 17 + [(None, None)] * 3
    lines = [(o, p, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", datetime(2000, 1, 1)) for o, p in pairs]
    frame(SCHEMAS["lineitem"], *lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    # some orders before the delta, some in it, some without a day, and order 3 twice
    days = [datetime(2000, 1, 1), datetime(2001, 5, 1), None]
    orders = [(k, 1, "O", 1.0, days[k % 3], "5-LOW") for k in [*range(120), 3]]
    frame(SCHEMAS["orders"], *orders).write.parquet(f"{tmp_path}/orders.parquet")

    checked = QUERIES["check_fact_grain_of_load"](large_tables, str(tmp_path))
    text = plan(checked)
    tasks = dealt_by(text, "order_id", "product_id")
    assert tasks and set(tasks) == {10}
    # lines are not sorted by order for being told apart, and the table's keys not for the look-up
    assert "SortMergeJoin [order_id" not in text
    sorted_keys = [x for x in text.splitlines() if "SortMergeJoin" in x and "LeftSemi" in x]
    assert len(sorted_keys) == 1  # the keys of the load that were met
    row = checked.first()
    extra = sum(n - 1 for n in Counter(pairs).values())
    assert (row.total_filas_evaluadas, row.registros_afectados) == (1000, extra)


def test_dealt_rows_give_the_same_figures(large_tables, frame, monkeypatch):
    monkeypatch.setattr(ck, "ROWS_A_TASK", 4, raising=False)
    types = "a bigint, b string"
    table = frame(types, (1, "x"), (1, "x"), (2, None), (None, "y"), (None, None), (4, "z"))
    load = frame(types, (1, "x"), (2, None), (2, None), (None, None), (3, "x"), (3, "x"), (None, "z"))
    assert ck.measure_duplicates(table, GRAIN, 6).first() == ck.measure_duplicates(table, GRAIN).first() == (6, 1)
    assert ck.measure_duplicates(load, GRAIN, 0).first() == (7, 2)
    plain = increments.duplicates_of_load(load, table, GRAIN).first()
    assert increments.duplicates_of_load(load, table, GRAIN, 13).first() == plain == (7, 5)
    none = load.filter("a > 9")
    assert increments.duplicates_of_load(none, table, GRAIN, 13).first() == (0, 0)
    single = ck.Rule(ck.KEY_DUPLICATES, "t", ("a",))
    assert increments.duplicates_of_load(load, table, single, 13).first() == increments.duplicates_of_load(load, table, single).first()
