"""The given tables in the shape of the staged model.

`Inputs` gives each frame lazily; `silostar.workload.oracle` states the same mapping in SQL.
Dirt (blank places, orphans, bad text, new and changed rows) is derived from the rows' own
values, so it grows with the tables.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silostar.functions.columns import date_key, line_amounts
from silostar.plans import star

AMOUNT = "decimal(12,2)"
DISCOUNT = "decimal(4,2)"
BATCH_TS = datetime(2024, 6, 30, 12, 0, 0)  # one fixed batch time, the same in the SQL
LOAD_TS = datetime(2024, 1, 1, 0, 0, 0)
DELTA_FROM = "2001-01-01"  # orders from this day on arrive with the delta


# Declared, so that opening a table reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def null(to: str = "string") -> Column:
    return F.lit(None).cast(to)


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table, opened once."""
        if name not in self._tables:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def places(self) -> DataFrame:
        """Nations with the name of their region."""
        region = self.table("region")
        return self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    # Staged tables ----------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        nation = F.col("n_name")
        padded = F.concat(F.lit(" "), nation, F.lit("  "))
        return (
            self.table("customer")
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("company_name"),
                null().alias("contact_name"),
                F.col("c_mktsegment").alias("contact_title"),
                F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.col("c_mktsegment")).alias("city"),
                F.col("r_name").alias("region"),
                null().alias("postal_code"),
                F.when(F.col("c_mktsegment") == "MACHINERY", padded).otherwise(nation).alias(
                    "country"
                ),
                F.col("c_nationkey").cast("string").alias("phone"),
                null().alias("fax"),
            )
        )

    @cached_property
    def employees(self) -> DataFrame:
        return self.places.select(
            F.col("n_nationkey").alias("employee_id"),
            F.col("n_name").alias("first_name"),
            F.col("r_name").alias("last_name"),
            F.lit("Sales").alias("title"),
            null().alias("city"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("n_regionkey").alias("reports_to"),
        )

    @cached_property
    def shippers(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("shipper_id"),
            F.col("r_name").alias("company_name"),
            null().alias("phone"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        kind = self.table("part").filter("p_type <> 'PROMO'").select("p_type").distinct()
        return kind.select(
            F.col("p_type").alias("category_id"), F.lower("p_type").alias("category_name")
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("company_name")
        )

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_id"),
            size.cast("bigint").alias("supplier_id"),
            F.col("p_brand").alias("quantity_per_unit"),
            F.col("p_retailprice").cast(AMOUNT).alias("unit_price"),
            F.when(F.col("p_brand") != "Brand#1", size - 10).alias("units_in_stock"),
            F.when(F.col("p_brand") != "Brand#2", size).alias("units_on_order"),
            F.when(F.col("p_type") != "SMALL", 15).alias("reorder_level"),
            F.when(F.col("p_type") == "ECONOMY", 1).otherwise(0).alias("discontinued"),
        )

    @cached_property
    def order_headers(self) -> DataFrame:
        """What the orders table alone gives: no join where none is needed."""
        ordered = F.col("o_orderdate")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            ordered.alias("order_date"),
            (ordered + F.expr("INTERVAL 30 DAYS")).alias("required_date"),
            F.when(F.col("o_orderstatus") != "O", ordered + F.expr("INTERVAL 7 DAYS")).alias(
                "shipped_date"
            ),
            F.col("o_totalprice").cast(AMOUNT).alias("freight"),
            F.col("o_orderpriority").alias("ship_city"),
            F.col("o_orderstatus").alias("ship_postal_code"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Order headers with the customer's nation as delivery place, its sales person and
        the region's shipper."""
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        return (
            self.order_headers.join(customer, F.col("customer_id") == F.col("c_custkey"), "left")
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                *self.order_headers.columns,
                F.col("c_nationkey").alias("employee_id"),
                F.col("n_regionkey").alias("ship_via"),
                F.col("n_name").alias("ship_country"),
                F.when(F.col("ship_city") != "5-LOW", F.col("r_name")).alias("ship_region"),
            )
        )

    @cached_property
    def order_details(self) -> DataFrame:
        """l_extendedprice is the gross amount of the line, not a unit price."""
        gross = F.col("l_extendedprice").cast(AMOUNT)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_number"),
            gross.alias("unit_price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_returnflag") != "N", F.col("l_discount").cast(DISCOUNT)).alias(
                "discount"
            ),
            gross.alias("gross_amount"),
        )

    # Delta ------------------------------------------------------------------
    def before_delta(self, orders: DataFrame) -> DataFrame:
        return orders.filter(F.col("order_date") < F.lit(DELTA_FROM).cast("timestamp_ntz"))

    def in_delta(self, orders: DataFrame) -> DataFrame:
        return orders.filter(F.col("order_date") >= F.lit(DELTA_FROM).cast("timestamp_ntz"))

    @cached_property
    def base_orders(self) -> DataFrame:
        return self.before_delta(self.orders)

    @cached_property
    def delta_orders(self) -> DataFrame:
        return self.in_delta(self.orders)

    @cached_property
    def base_customers(self) -> DataFrame:
        """Customers known before the delta; the FURNITURE segment arrives with it."""
        return self.customers.filter("contact_title <> 'FURNITURE'")

    @cached_property
    def delta_customers(self) -> DataFrame:
        """All customers; those with a blank city come with another title, and those of
        AFRICA with a fax instead of none."""
        title = F.when(F.trim("city") == "", "ALTERED").otherwise(F.col("contact_title"))
        fax = F.when(F.col("region") == "AFRICA", F.col("phone")).otherwise(F.col("fax"))
        return self.customers.withColumns({"contact_title": title, "fax": fax})

    @cached_property
    def early_orders(self) -> DataFrame:
        """Orders before the delta that the first twenty employees took: the delta brings
        places that they never delivered to."""
        return self.base_orders.filter("employee_id < 20")

    @cached_property
    def base_products(self) -> DataFrame:
        """Products known before the delta; one brand arrives with it."""
        return self.products.filter("quantity_per_unit <> 'Brand#3'")

    @cached_property
    def delta_products(self) -> DataFrame:
        """All products; those of one category come with another name, and those without a
        reorder level get one."""
        named = F.when(
            F.col("category_id") == "ECONOMY", F.concat("product_name", F.lit(" (new)"))
        ).otherwise(F.col("product_name"))
        level = F.coalesce("reorder_level", F.lit(12))
        return self.products.withColumns({"product_name": named, "reorder_level": level})

    # Dimensions, with natural keys as keys ----------------------------------
    def keyed(self, table: str, column: str, name: str) -> DataFrame:
        natural = F.col(column)
        return self.table(table).select(natural.alias(f"{name}_id"), natural.alias(f"{name}_key"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.keyed("customer", "c_custkey", "customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.keyed("part", "p_partkey", "product")

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self.geography(self.orders)

    def geography(self, orders: DataFrame) -> DataFrame:
        places = star.source_geo(self.customers, self.employees, orders)
        signature = F.col("geography_signature").alias("geography_key")
        return star.build_dim_geography(places).select("*", signature)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "date": star.build_dim_date(self.order_headers),
            "geography": self.dim_geography,
            "customer": self.dim_customer,
            "product": self.dim_product,
            "employee": self.keyed("nation", "n_nationkey", "employee"),
            "shipper": self.keyed("region", "r_regionkey", "shipper"),
        }

    @cached_property
    def sales(self) -> DataFrame:
        """The columns of the fact that the metrics read: lines with the order's customer
        and day."""
        headers = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_key"),
            date_key(F.to_date("o_orderdate")).alias("order_date_key"),
        )
        return self._sold(headers)

    @cached_property
    def placed_sales(self) -> DataFrame:
        """The same with the delivery nation, for the sales product."""
        headers = (
            self.table("orders")
            .join(
                self.table("customer").select("c_custkey", "c_nationkey"),
                F.col("o_custkey") == F.col("c_custkey"),
            )
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_key"),
                F.col("c_nationkey").alias("ship_geography_key"),
                date_key(F.to_date("o_orderdate")).alias("order_date_key"),
            )
        )
        return self._sold(headers)

    def _sold(self, headers: DataFrame) -> DataFrame:
        gross = F.col("l_extendedprice").cast(AMOUNT)
        discount = F.col("l_discount").cast(DISCOUNT)
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_key"),
            F.col("l_quantity").cast("int").alias("quantity"),
            *line_amounts(gross, discount, null_discount=0),
        )
        # Lines are grouped by order afterwards: a merge join leaves them placed for it, where
        # a broadcast of the headers would have the lines moved by the grouping.
        return lines.hint("merge").join(headers, "order_id")

    @cached_property
    def order_days(self) -> DataFrame:
        return star.build_dim_date(self.table("orders"), ["o_orderdate"])

    # Enrichment -------------------------------------------------------------
    @cached_property
    def countries(self) -> DataFrame:
        """A country file made of the nations of all regions but EUROPE: two nations under
        another name, two without a code, blanks where the region is ASIA."""
        name = F.col("n_name")
        renamed = F.when(name == "NATION_1", "First Nation").when(
            name == "NATION_2", "Second Nation"
        )
        asia = F.col("r_name") == "ASIA"
        return self.places.filter("r_name <> 'EUROPE'").select(
            F.coalesce(renamed, name).alias("country"),
            F.when(F.col("n_nationkey").isin(2, 6), " ")
            .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
            .alias("iso_code"),
            F.concat(F.lit("Capital of "), name).alias("capital"),
            F.when(asia, "").otherwise(F.col("r_name")).alias("official_language"),
            F.concat(F.substring("r_name", 1, 2), F.lit("D")).alias("currency_code"),
            F.when(~asia, (F.col("n_nationkey") + 0.5).cast("string")).alias("latitude"),
            (F.lit(0) - F.col("n_nationkey")).cast("string").alias("longitude"),
        )

    @cached_property
    def nation_geography(self) -> DataFrame:
        """Delivery places at nation level, not yet enriched."""
        return self.places.select(
            F.col("n_nationkey").alias("geography_key"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def enriched_geography(self) -> DataFrame:
        from silostar.plans.enrichment import enrich_geography

        return enrich_geography(
            self.nation_geography, self.countries, COUNTRY_ALIASES, ISO_FALLBACK
        )

    @cached_property
    def raw_scores(self) -> DataFrame:
        """A score line per customer from the account balance (blank when negative) and one
        per order from its priority (none unless it is pending), so that customers repeat."""
        balance = F.col("c_acctbal")
        own = self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.when(balance < 0, "").otherwise(F.floor(balance / 2500).cast("string")).alias(
                "score"
            ),
        )
        ordered = self.table("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "P", F.substring("o_orderpriority", 1, 1)).alias("score"),
        )
        return own.unionByName(ordered)

    @cached_property
    def customer_scores(self) -> DataFrame:
        """The score table: account balance in steps, none when negative."""
        balance = F.col("c_acctbal")
        return self.table("customer").filter("c_acctbal >= 0").select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_custkey").alias("customer_id"),
            F.least(F.floor(balance / 2000), F.lit(5)).cast("int").alias("score"),
            F.lit(str(LOAD_TS)).cast("timestamp_ntz").alias("fecha_carga"),
        )

    # Logs -------------------------------------------------------------------
    @cached_property
    def check_log(self) -> DataFrame:
        kind, user = F.col("event_type"), F.col("user_id").cast("string")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("table_"), user).alias("tabla"),
            F.when(kind != "view", kind).alias("columna"),
            F.when(F.col("value") < 50, "NOT_NULL").otherwise("PK_NULOS").alias("tipo_chequeo"),
            F.when(kind == "signup", "check_raw").otherwise("check_keys").alias("nombre_script"),
            F.to_date("ts").cast("timestamp_ntz").alias("fecha"),
            F.lit(1000).cast("bigint").alias("total_filas_evaluadas"),
            F.floor("value").cast("bigint").alias("registros_afectados"),
            (F.col("value") / 1000).alias("indicador_calculado"),
            F.lit(0.0).alias("umbral_aplicado"),
            F.when(F.col("value") >= 100, "ERROR").otherwise("OK").alias("resultado"),
        )

    @cached_property
    def event_log(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("table_"), F.col("user_id").cast("string")).alias("tabla"),
            F.upper(kind).alias("tipo_evento"),
            F.lit("load").alias("nombre_script"),
            F.col("ts").alias("fecha_inicio"),
            (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("fecha_fin"),
            F.when(kind != "error", F.floor("value")).cast("bigint").alias("registros_procesados"),
            F.when(kind == "error", "ERROR").otherwise("OK").alias("estado"),
        )


# Names of the country file that differ from the warehouse's.
COUNTRY_ALIASES = {"NATION_1": "First Nation", "NATION_2": "Second Nation"}
ISO_FALLBACK = {"NATION_2": "XX"}
