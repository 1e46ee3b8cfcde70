"""Star schema: dimensions and the order-line fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.functions.columns import (
    date_attributes,
    full_name,
    geo_signature,
    line_amounts,
    stock_alarm,
)
from silostar.model import CUSTOMER_ATTRIBUTES
from silostar.operators.merge import not_present

PLACE = ("country", "region", "city", "postal_code")
ORDER_DATES = ("order_date", "required_date", "shipped_date")


# Dates ----------------------------------------------------------------------
def source_dates(orders: DataFrame, columns: Sequence[str] = ORDER_DATES) -> DataFrame:
    """Distinct days of several date columns, in one scan."""
    days = F.explode(F.array(*[F.to_date(c) for c in columns]))
    return orders.select(days.alias("full_date")).filter("full_date IS NOT NULL").distinct()


def build_dim_date(orders: DataFrame, columns: Sequence[str] = ORDER_DATES) -> DataFrame:
    return source_dates(orders, columns).select(*date_attributes("full_date"))


def extend_dim_date(
    dim_date: DataFrame, orders: DataFrame, columns: Sequence[str] = ORDER_DATES
) -> DataFrame:
    """Rows to add for days the dimension does not have."""
    return not_present(build_dim_date(orders, columns), dim_date, ["full_date"])


# Geography ------------------------------------------------------------------
def source_geo(customers: DataFrame, employees: DataFrame, orders: DataFrame) -> DataFrame:
    """Places of customers, employees (no postal code) and deliveries."""
    return (
        customers.select(*PLACE)
        .unionByName(employees.select(*PLACE[:3]), allowMissingColumns=True)
        .unionByName(ship_places(orders))
    )


def ship_places(orders: DataFrame) -> DataFrame:
    return orders.select(*[F.col(f"ship_{c}").alias(c) for c in PLACE])


def build_dim_geography(places: DataFrame) -> DataFrame:
    """One row per signature, with the smallest spelling of each attribute.

    Distinct places come first: that is a hash aggregate, which reduces each map task to a
    few rows. The lowest texts need a sort aggregate, which then sorts distinct places only.
    """
    signature = geo_signature(*PLACE).alias("geography_signature")
    distinct = places.select(*PLACE).distinct()
    return distinct.groupBy(signature).agg(*[F.min(c).alias(c) for c in PLACE])


def extend_dim_geography(
    dim: DataFrame, orders: DataFrame, customers: DataFrame | None = None
) -> DataFrame:
    """Rows to add for delivery places (and places of customers) the dimension does not
    have."""
    places = ship_places(orders)
    if customers is not None:
        places = places.unionByName(customers.select(*PLACE))
    return not_present(build_dim_geography(places), dim, ["geography_signature"])


def _with_place(df: DataFrame, signature: Column, geography: DataFrame, key: str) -> DataFrame:
    places = geography.select("geography_signature", F.col("geography_key").alias(key))
    return df.withColumn("geography_signature", signature).join(places, "geography_signature")


# Other dimensions -----------------------------------------------------------
def build_dim_customer(customers: DataFrame, geography: DataFrame) -> DataFrame:
    key = "customer_geography_key"
    placed = _with_place(customers, geo_signature(*PLACE), geography, key)
    return placed.select("customer_id", key, *CUSTOMER_ATTRIBUTES)


def denormalise_products(
    products: DataFrame, categories: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Products with the names of their category and supplier and the stock alarm."""
    named = categories.select("category_id", "category_name")
    supplied = suppliers.select("supplier_id", F.col("company_name").alias("supplier_name"))
    return (
        products.join(named, "category_id", "left")
        .join(supplied, "supplier_id", "left")
        .select(
            "product_id", "product_name", "category_id", "category_name", "supplier_id",
            "supplier_name", "quantity_per_unit", "unit_price", "units_in_stock",
            "units_on_order", "reorder_level", "discontinued",
            stock_alarm("units_in_stock", "reorder_level").alias("stock_alarm_level"),
        )
    )


def build_dim_employee(employees: DataFrame, geography: DataFrame) -> DataFrame:
    key = "employee_geography_key"
    signature = geo_signature("country", "region", "city")
    return _with_place(employees, signature, geography, key).select(
        "employee_id", key, full_name("first_name", "last_name").alias("employee_name"),
        "title", "city", "region", "country", "reports_to",
    )


def build_dim_shipper(shippers: DataFrame) -> DataFrame:
    return shippers.select("shipper_id", "company_name", "phone")


# Fact -----------------------------------------------------------------------
def resolve_orders(orders: DataFrame, dims: Mapping[str, DataFrame], how: str) -> DataFrame:
    """Order headers with dimension keys instead of natural keys.

    Done once per order, before the lines are joined, so that the header lookups move
    orders and not lines. Sides are broadcast only if Spark's size check allows it.
    """
    place = [F.col(f"ship_{c}") for c in PLACE]
    headers = orders.select(
        "order_id", "customer_id", "employee_id",
        F.col("ship_via").alias("shipper_id"),
        F.col("freight").alias("order_freight_amount"),
        geo_signature(*place).alias("geography_signature"),
        *[F.to_date(c).alias(c) for c in ORDER_DATES],
    )
    customer = dims["customer"].select("customer_id", "customer_key")
    employee = dims["employee"].select("employee_id", "employee_key")
    shipper = dims["shipper"].select("shipper_id", "shipper_key")
    geography = dims["geography"].select(
        "geography_signature", F.col("geography_key").alias("ship_geography_key")
    )
    resolved = (
        headers.join(customer, "customer_id")
        .join(employee, "employee_id", how)
        .join(shipper, "shipper_id", how)
        .join(geography, "geography_signature", how)
    )
    for column in ORDER_DATES:
        day = dims["date"].select(
            F.col("full_date").alias(column), F.col("date_key").alias(f"{column}_key")
        )
        kind = "left" if column == "shipped_date" else how
        resolved = resolved.join(day, column, kind)
    return resolved.select(
        "order_id", "customer_key", "employee_key", "shipper_key", "ship_geography_key",
        *[f"{c}_key" for c in ORDER_DATES], "order_freight_amount",
    )


def build_fact(
    lines: DataFrame, orders: DataFrame, dims: Mapping[str, DataFrame], mode: str = "strict",
    headers: DataFrame | None = None,
) -> DataFrame:
    """Order lines with dimension keys and amounts.

    ``strict`` (initial load): a line needs every dimension but the shipping date, and a
    missing discount counts as 0. ``lenient`` (delta): only customer and product are
    needed, and a missing discount stays missing.

    ``headers`` are the orders as ``resolve_orders`` gives them, if they were written before:
    a small batch of known size is then broadcast, and the lines do not move.

    A ``gross_amount`` column of ``lines`` is taken as it is; otherwise it is price times
    quantity. Freight belongs to the order and repeats on each line: do not sum it.
    """
    strict = mode == "strict"
    if headers is None:
        headers = resolve_orders(orders, dims, "inner" if strict else "left")
    product = dims["product"].select("product_id", "product_key")
    if "gross_amount" in lines.columns:
        gross = F.col("gross_amount")
    else:
        gross = F.col("unit_price") * F.col("quantity")
    discount = F.col("discount")
    if strict:
        discount = F.coalesce(discount, F.lit(0).cast(lines.schema["discount"].dataType))
    return (
        lines.join(headers, "order_id")
        .join(product, "product_id")
        .select(
            "order_id", "product_id", "customer_key", "product_key", "employee_key",
            "shipper_key", "ship_geography_key", *[f"{c}_key" for c in ORDER_DATES],
            "unit_price", "quantity", discount.alias("discount"),
            *line_amounts(gross, discount), "order_freight_amount",
        )
    )


def dropped_lines(
    lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Lines that no fact row can be made of: order, customer or product is unknown."""
    headers = orders.join(customers.select("customer_id"), "customer_id", "left_semi")
    usable = lines.join(headers.select("order_id"), "order_id", "left_semi").join(
        products.select("product_id"), "product_id", "left_semi"
    )
    keys = ["order_id", "product_id"]
    return lines.join(usable.select(*keys).distinct(), keys, "left_anti")


def order_freight(fact: DataFrame) -> DataFrame:
    """Freight once per order, the grain at which it may be summed."""
    return fact.groupBy("order_id").agg(
        F.max("order_freight_amount").alias("order_freight_amount")
    )
