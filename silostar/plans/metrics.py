"""Sales metrics derived from the fact, in full or from additive state.

State is kept at two levels, so that a delta costs what it touches. Partial aggregates per
(customer, order) and per (product, order) hold what each load brought; they only grow by
appends, and rows of one key add up. Totals per customer and per product add up orders. When
lines come in, their orders are looked up among the partials (by key range), the totals take
what these orders now count for instead of before, and the fact is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AMOUNTS = ("gross_amount", "discount_amount", "net_amount")
CUSTOMER_ORDER = ("customer_key", "order_id")
PRODUCT_ORDER = ("product_key", "order_id")


def _mean(total: Column, count: Column) -> Column:
    return total.cast("double") / F.nullif(count, F.lit(0))


def _days(dim_date: DataFrame, key: str) -> DataFrame:
    """Known days. A calendar has at most 3.7 million days of 12 bytes, which bounds what
    is broadcast."""
    return F.broadcast(dim_date.select(F.col("date_key").alias(key), "full_date"))


def _same_types(df: DataFrame, like: DataFrame) -> DataFrame:
    """Sums of sums widen their type; back to that of ``like``."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


# Customers ------------------------------------------------------------------
def customer_orders(fact: DataFrame) -> DataFrame:
    """Partial aggregates per customer and order: first day, lines, quantity and amounts."""
    return fact.groupBy(*CUSTOMER_ORDER).agg(
        F.min("order_date_key").alias("date_key"),
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        *[F.sum(c).alias(c) for c in _AMOUNTS],
    )


def merged_customer_orders(partials: DataFrame) -> DataFrame:
    """One row per customer and order from the partials of several loads."""
    merged = partials.groupBy(*CUSTOMER_ORDER).agg(
        F.min("date_key").alias("date_key"),
        *[F.sum(c).alias(c) for c in ("lines", "quantity", *_AMOUNTS)],
    )
    return _same_types(merged, partials)


def customer_totals(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per customer: sums over all orders, and figures of the orders whose day is known.
    Orders without a known day keep their lines but do not count as orders."""
    dated = F.col("full_date").isNotNull()
    net = F.when(dated, F.col("net_amount"))
    return (
        orders.join(_days(dim_date, "date_key"), "date_key", "left")
        .groupBy("customer_key")
        .agg(
            F.count_if(dated).alias("order_count"),
            F.sum("lines").alias("order_line_count"),
            F.sum("quantity").alias("total_quantity"),
            *[F.sum(c).alias(c) for c in _AMOUNTS],
            F.sum(net).alias("dated_net"),
            F.count(net).alias("dated_net_count"),
            F.min("full_date").alias("first_order_date"),
            F.max("full_date").alias("last_order_date"),
        )
    )


def updated_customer_totals(
    totals: DataFrame, touched: DataFrame, before: DataFrame, dim_date: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Totals of the customers with touched orders, and the keys of those customers that
    cannot be brought up to date by adding.

    ``touched`` are the merged partials of the new lines, ``before`` those of the same orders
    as they were. An order counts once, with all its lines; what it counted for before is
    taken off. If an order's day moved or became unknown, the customer's first and last day
    may be others: such customers are to be worked out from all their orders.
    """
    days = _days(dim_date, "date_key")

    def placed(orders: DataFrame) -> DataFrame:
        return orders.join(days, "date_key", "left")

    now = placed(merged_customer_orders(touched.unionByName(before)))
    was = placed(before)
    after, earlier = now.alias("a"), was.alias("b")
    both = after.join(earlier, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in CUSTOMER_ORDER])
    moved = both.filter(
        F.col("b.full_date").isNotNull() & ~F.col("a.full_date").eqNullSafe(F.col("b.full_date"))
    ).select("a.customer_key").distinct()

    def counted(orders: DataFrame, sign: int) -> DataFrame:
        dated = F.col("full_date").isNotNull()
        net = F.when(dated, F.col("net_amount"))
        none = F.lit(None)
        return orders.select(
            "customer_key", (dated.cast("bigint") * sign).alias("order_count"),
            *[none.cast(totals.schema[c].dataType).alias(c) for c in ("order_line_count", "total_quantity", *_AMOUNTS)],
            (net * sign).alias("dated_net"), (net.isNotNull().cast("bigint") * sign).alias("dated_net_count"),
            F.col("full_date").alias("first_order_date"), F.col("full_date").alias("last_order_date"),
        )

    def added(orders: DataFrame) -> DataFrame:
        zero, none = F.lit(0).cast("bigint"), F.lit(None)
        return orders.select(
            "customer_key", zero.alias("order_count"), F.col("lines").alias("order_line_count"),
            F.col("quantity").alias("total_quantity"), *_AMOUNTS, none.cast("decimal(38,6)").alias("dated_net"),
            zero.alias("dated_net_count"), none.cast("date").alias("first_order_date"),
            none.cast("date").alias("last_order_date"),
        )

    kept = totals.join(touched.select("customer_key").distinct(), "customer_key", "left_semi")
    rows = kept.unionByName(counted(now, 1)).unionByName(counted(was, -1)).unionByName(added(touched))
    sums = ("order_count", "order_line_count", "total_quantity", *_AMOUNTS, "dated_net", "dated_net_count")
    updated = rows.groupBy("customer_key").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
    )
    return _same_types(updated, totals), moved


def customer_metrics(totals: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The metric columns of totals of customers that have orders."""
    return (
        totals.filter("order_count > 0")
        .withColumn("avg_order_net_amount", _mean(F.col("dated_net"), F.col("dated_net_count")))
        .join(dim_customer.select("customer_key", "customer_id"), "customer_key")
        .select(
            "customer_key", "order_count", "order_line_count", "total_quantity", *_AMOUNTS,
            "avg_order_net_amount", "first_order_date", "last_order_date", "customer_id",
        )
    )


def customer_sales_metrics(
    fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Per customer with sales: lines, quantity, amounts, and figures per order.

    The fact is read once: line figures are sums of the per-order sums that the order
    figures need anyway. Grouping by customer and order first spreads a customer who has
    much of the fact over many tasks.
    """
    return customer_metrics(customer_totals(customer_orders(fact), dim_date), dim_customer)


# Products -------------------------------------------------------------------
def product_orders(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Partial aggregates per product and order, of the lines whose day is known."""
    dated = fact.join(_days(dim_date, "order_date_key"), "order_date_key")
    return dated.groupBy(*PRODUCT_ORDER).agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity"),
        *[F.sum(c).alias(c) for c in _AMOUNTS], F.count("net_amount").alias("net_count"),
        F.min("full_date").alias("first_order_date"), F.max("full_date").alias("last_order_date"),
    )


_PRODUCT_SUMS = {
    "lines": "order_line_count", "quantity": "total_quantity", **{c: c for c in _AMOUNTS}, "net_count": "net_count",
}


def _summed(rows: DataFrame, names: Sequence[str]) -> list[Column]:
    return [
        *[F.sum(c).alias(n) for c, n in zip(names, _PRODUCT_SUMS.values())],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
    ]


def product_totals(orders: DataFrame) -> DataFrame:
    """Per product: orders, lines, quantity, amounts, first and last day. ``orders`` has one
    row per product and order."""
    return orders.groupBy("product_key").agg(
        F.count("*").alias("order_count"), *_summed(orders, list(_PRODUCT_SUMS))
    )


def merged_product_orders(partials: DataFrame) -> DataFrame:
    """One row per product and order from the partials of several loads."""
    merged = partials.groupBy(*PRODUCT_ORDER).agg(
        *[F.sum(c).alias(c) for c in _PRODUCT_SUMS],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
    )
    return _same_types(merged, partials)


def updated_product_totals(totals: DataFrame, touched: DataFrame, known: DataFrame) -> DataFrame:
    """Totals of the products with new lines. Lines only come in, so everything adds up but
    the count of orders, which leaves out the pairs that were ``known`` before."""
    fresh = touched.join(known.select(*PRODUCT_ORDER).distinct(), list(PRODUCT_ORDER), "left_anti")
    counts = fresh.groupBy("product_key").agg(F.count("*").alias("order_count"))
    more = product_totals(touched).drop("order_count").join(counts, "product_key", "left").fillna(0, ["order_count"])
    kept = totals.join(touched.select("product_key").distinct(), "product_key", "left_semi")
    rows = kept.unionByName(_same_types(more, totals))
    names = list(_PRODUCT_SUMS.values())
    updated = rows.groupBy("product_key").agg(F.sum("order_count").alias("order_count"), *_summed(rows, names))
    return _same_types(updated, totals)


def product_metrics(totals: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The metric columns of totals. Products are joined to one row each."""
    return (
        totals.withColumn("avg_line_net_amount", _mean(F.col("net_amount"), F.col("net_count")))
        .join(dim_product.select("product_key", "product_id"), "product_key")
        .select(
            "product_key", "order_count", "order_line_count", "total_quantity", *_AMOUNTS,
            "avg_line_net_amount", "first_order_date", "last_order_date", "product_id",
        )
    )


def product_sales_metrics(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Per product with sales: orders, lines, quantity, amounts, mean line, first and last
    day."""
    return product_metrics(product_totals(product_orders(fact, dim_date)), dim_product)
