"""Physical plans: what must not appear in them, with and without broadcasts."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from silostar.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables not present")


@pytest.fixture
def large_tables(spark):
    """Plan as for tables that are too large to broadcast."""
    for setting in THRESHOLDS:
        spark.conf.set(setting, "-1")
    yield spark
    for setting in THRESHOLDS:
        spark.conf.unset(setting)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops_and_no_python(large_tables):
    for name in QUERIES:
        text = plan(entry.queries()[name](large_tables, FOLDER))
        for operator in ("NestedLoop", "Cartesian", "PythonUDF", "ArrowEval", "ExistingRDD"):
            assert operator not in text, (name, operator)


def test_checks_on_rows_do_not_shuffle_rows(large_tables):
    for name in ("check_measures", "check_format_timestamp", "check_pk_nulls", "check_stock"):
        text = plan(entry.queries()[name](large_tables, FOLDER))
        assert "hashpartitioning" not in text and text.count("FileScan") == 1, name


def test_scans_read_only_the_columns_they_need(large_tables):
    text = plan(entry.queries()["check_fact_grain"](large_tables, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_sales_orders_stay_partitioned_by_order(large_tables):
    """Lines move once, for the join by order; reducing them to orders moves nothing."""
    text = plan(entry.queries()["dp01_sales_geo_score"](large_tables, FOLDER))
    lines = [t for t in text.splitlines() if "Exchange hashpartitioning(order_id" in t]
    assert len(lines) == 2  # one for the lines, one for the order headers


def test_latest_rows_are_pruned_before_the_shuffle(large_tables):
    text = plan(entry.queries()["latest_checks"](large_tables, FOLDER))
    assert text.count("WindowGroupLimit") == 2


def test_sales_copies_no_rows(large_tables):
    assert "Expand" not in plan(entry.queries()["dp01_sales_geo_score"](large_tables, FOLDER))


def test_lines_do_not_move_for_a_small_batch_of_written_headers(spark, tmp_path, frame):
    from silostar.plans import star

    spark.range(50_000).selectExpr(
        "id AS order_id", "id % 50 AS product_id", "CAST(1 AS DECIMAL(12,4)) AS unit_price",
        "CAST(2 AS INT) AS quantity", "CAST(0 AS DECIMAL(12,10)) AS discount",
    ).write.parquet(f"{tmp_path}/lines")
    headers = spark.range(20).selectExpr(
        "id AS order_id", *(f"id AS {c}" for c in ("customer_key", "employee_key", "shipper_key", "ship_geography_key")),
        *(f"CAST(id AS INT) AS {c}_key" for c in star.ORDER_DATES), "CAST(1 AS DECIMAL(12,4)) AS order_freight_amount",
    )
    headers.write.parquet(f"{tmp_path}/headers")
    dims = {"product": frame("product_id bigint, product_key bigint", *((i, i) for i in range(50)))}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30000")
    try:
        fact = star.build_fact(
            spark.read.parquet(f"{tmp_path}/lines"), None, dims, "lenient", spark.read.parquet(f"{tmp_path}/headers")
        )
        lines = plan(fact).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "discount" in x)
    join = max(i for i, x in enumerate(lines[:scan]) if "Join" in x)
    assert "BroadcastHashJoin [order_id" in lines[join]
    assert not any("Exchange" in x for x in lines[join:scan])
