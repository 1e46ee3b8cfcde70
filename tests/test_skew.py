"""One key with a third of the rows: results against brute force, and joins that split it."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silostar.operators import checks as ck
from silostar.operators.profile import profile
from silostar.operators.ranking import latest
from silostar.plans import metrics, star

N = 30_000
SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def splitting(spark):
    """Adaptive execution at the scale of the test."""
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield spark
    for key in SPLITTING:
        spark.conf.unset(key)


def hot(column, others):
    """Key 0 for a third of the rows, the rest spread."""
    return F.when(column % 3 == 0, 0).otherwise(column % others)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_in_the_fact(splitting):
    rows = splitting.range(N)
    lines = rows.select(
        F.floor(F.col("id") / 3).alias("order_id"),
        hot(F.col("id"), 400).alias("product_id"),
        F.lit(2).alias("quantity"),
        F.lit(1.5).cast("decimal(12,4)").alias("unit_price"),
        F.lit(0).cast("decimal(8,6)").alias("discount"),
    )
    orders = splitting.range(N // 3).select(
        F.col("id").alias("order_id"),
        hot(F.col("id"), 50).alias("customer_id"),
        F.lit(1).alias("employee_id"),
        F.lit(1).alias("ship_via"),
        F.lit(1).cast("decimal(12,4)").alias("freight"),
        *[F.lit("2024-01-02").cast("timestamp_ntz").alias(c) for c in star.ORDER_DATES],
        *[F.lit("x").alias(f"ship_{c}") for c in star.PLACE],
    )

    def keyed(name, n):
        ids = splitting.range(n)
        return ids.select(F.col("id").alias(f"{name}_id"), F.col("id").alias(f"{name}_key"))

    geography = star.build_dim_geography(star.ship_places(orders))
    dims = {
        "date": star.build_dim_date(orders),
        "geography": geography.withColumn("geography_key", F.col("geography_signature")),
        "customer": keyed("customer", 50), "product": keyed("product", 400),
        "employee": keyed("employee", 2), "shipper": keyed("shipper", 2),
    }
    fact = star.build_fact(lines, orders, dims)
    shown = fact.select("product_key", "customer_key", "net_amount")
    got = Counter((r.product_key, r.customer_key) for r in shown.collect())
    expected = Counter(
        (0 if i % 3 == 0 else i % 400, 0 if (i // 3) % 3 == 0 else (i // 3) % 50)
        for i in range(N)
    )
    assert got == expected
    assert "skew=true" in final_plan(shown)

    by_product = metrics.product_sales_metrics(fact, dims["product"], dims["date"])
    figures = {r.product_key: (r.order_count, r.order_line_count) for r in by_product.collect()}
    hot_orders = {i // 3 for i in range(N) if i % 3 == 0 or i % 400 == 0}
    assert figures[0] == (len(hot_orders), sum(n for (p, _), n in expected.items() if p == 0))

    by_customer = metrics.customer_sales_metrics(fact, dims["customer"], dims["date"])
    row = by_customer.filter("customer_key = 0").first()
    lines_of_0 = sum(n for (_, c), n in expected.items() if c == 0)
    assert (row.order_line_count, float(row.net_amount)) == (lines_of_0, 3.0 * lines_of_0)
    assert row.first_order_date == date(2024, 1, 2)


def test_hot_key_in_checks_profiles_and_latest(splitting):
    rows = splitting.range(N).select("id", hot(F.col("id"), 1000).alias("k"))
    values = Counter(0 if i % 3 == 0 else i % 1000 for i in range(N))
    parents = splitting.range(1, 900).select(F.col("id").alias("k"))
    checked = ck.run_checks(
        {"t": rows, "p": parents},
        [
            ck.Rule(ck.KEY_DUPLICATES, "t", ("k",)),
            ck.Rule(ck.FOREIGN_KEY, "t", ("k",), ("p",), "k"),
        ],
        datetime(2024, 1, 1), "s",
    )
    affected = {r.tipo_chequeo: r.registros_afectados for r in checked.collect()}
    assert affected[ck.KEY_DUPLICATES] == N - len(values)
    assert affected[ck.FOREIGN_KEY] == sum(n for k, n in values.items() if not 1 <= k < 900)

    ts = datetime(2024, 1, 1)
    figures = profile(rows, "t", ["k"], ts, "s").first()
    assert (figures.total_filas, figures.valores_distintos) == (N, len(values))

    last = latest(rows, ["k"], "id", "id")
    expected = {}
    for i in range(N):
        expected[0 if i % 3 == 0 else i % 1000] = i
    assert {r.k: r.id for r in last.collect()} == expected
