"""Published data products: sales by month, country and score segment, and the three
summaries of the quality tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.functions.columns import (
    NO_COUNTRY,
    period,
    score_segment_order,
    segment_of,
)
from silostar.operators.merge import ensure_columns, or_default
from silostar.plans.enrichment import GEO_ATTRIBUTES

NO_PROFILE = "sin_perfilado_disponible"  # fixed value


def _country_attributes(dim_geography: DataFrame) -> DataFrame:
    """The enriched attributes of each country. A place without a country has none."""
    return (
        ensure_columns(dim_geography, GEO_ATTRIBUTES)
        .groupBy("country")
        .agg(*[F.max(c).alias(c) for c in GEO_ATTRIBUTES])
    )


CELL = ("anio", "mes", "country", "score_segment_order")
MONTH = "clave_mes"  # year and month in one number: the key by which state is replaced
_SUMS = ("lines", "quantity", "gross", "discounted", "net")


def _orders(fact: DataFrame) -> DataFrame:
    """Lines reduced to orders, by all order-level keys: the result does not depend on an
    order having one customer, day or place."""
    return fact.groupBy("order_id", "customer_key", "order_date_key", "ship_geography_key").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("gross_amount").alias("gross"),
        F.sum("discount_amount").alias("discounted"),
        F.sum("net_amount").alias("net"),
    )


def _months(dim_date: DataFrame) -> DataFrame:
    """The months of known days (3.7 million days of a calendar at most: a bounded broadcast)."""
    return F.broadcast(dim_date.select(
        F.col("date_key").alias("order_date_key"),
        F.col("year_number").alias("anio"),
        F.col("month_number").alias("mes"),
    ))


def _places(dim_geography: DataFrame) -> DataFrame:
    return dim_geography.select(F.col("geography_key").alias("ship_geography_key"), "country")


def _segments(dim_customer: DataFrame, scores: DataFrame) -> DataFrame:
    return (
        dim_customer.select("customer_key")
        .join(scores.select("customer_key", "score"), "customer_key", "left")
        .select("customer_key", score_segment_order("score").alias("score_segment_order"))
    )


def _published(cells: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """The columns of the product. Country attributes describe the country and are not part
    of the key, so a place enriched later than others cannot split a cell; they join the
    finished cells."""
    mean = F.col("net").cast("double") / F.nullif(F.col("ordenes"), F.lit(0))
    return cells.join(_country_attributes(dim_geography), "country", "left").select(
        "anio", "mes", period("anio", "mes").alias("periodo"),
        F.coalesce("country", F.lit(NO_COUNTRY)).alias("ship_country"),
        *GEO_ATTRIBUTES, segment_of("score_segment_order").alias("score_segment"),
        "score_segment_order", "clientes_distintos", "ordenes",
        F.col("lines").alias("lineas_orden"), F.col("quantity").cast("bigint").alias("cantidad_total"),
        F.col("gross").alias("gross_amount"), F.col("discounted").alias("discount_amount"),
        F.col("net").alias("net_amount"), mean.alias("avg_order_net_amount"),
    )


def dp01_sales_geo_score(
    fact: DataFrame, dim_date: DataFrame, dim_geography: DataFrame, dim_customer: DataFrame,
    scores: DataFrame,
) -> DataFrame:
    """Sales by year, month, delivery country and score segment.

    Lines are first reduced to orders, and lookups run on orders. An order counts once in a
    cell, with its first customer there: others of the same order and cell follow as rows
    without figures, so that they are counted as customers. Where the lookups are broadcast,
    orders still lie as the lines do, and this moves nothing. The orders are then combined per
    cell and customer, and these per cell, each time before they move.
    """
    sums = [F.sum(c).alias(c) for c in _SUMS]
    in_cell = (
        _orders(fact)
        .join(_months(dim_date), "order_date_key")
        .join(_places(dim_geography), "ship_geography_key")
        .join(_segments(dim_customer, scores), "customer_key")
        .groupBy(*CELL, "order_id")
        .agg(*sums, F.collect_set("customer_key").alias("customers"))
    )
    placed = in_cell.select(*CELL, *_SUMS, F.posexplode("customers").alias("place", "customer_key"))
    first = F.col("place") == 0
    cells = (
        placed.groupBy(*CELL, "customer_key")
        .agg(F.count_if(first).alias("ordenes"), *[F.sum(F.when(first, F.col(c))).alias(c) for c in _SUMS])
        .groupBy(*CELL)
        .agg(F.count("*").alias("clientes_distintos"), F.sum("ordenes").alias("ordenes"), *sums)
    )
    return _published(cells, dim_geography)


# State: what a month's sales add up from --------------------------------------
def sales_state(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales per month, place and customer, with the number of their orders. Neither score
    nor country attributes are in it, so that these may change."""
    return (
        _orders(fact)
        .join(_months(dim_date), "order_date_key")
        .groupBy("order_id", "anio", "mes", "ship_geography_key", "customer_key")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
        .groupBy("anio", "mes", "ship_geography_key", "customer_key")
        .agg(F.count("*").alias("ordenes"), *[F.sum(c).alias(c) for c in _SUMS])
        .withColumn(MONTH, (F.col("anio") * 100 + F.col("mes")).cast("int"))
    )


def divided_orders(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The orders that have several customers or places in a month: a row for each. Only
    these make the orders of a cell fewer than the sum over its places and customers."""
    keys = fact.select("order_id", "customer_key", "order_date_key", "ship_geography_key")
    rows = (
        keys.join(_months(dim_date), "order_date_key")
        .select("order_id", "anio", "mes", "ship_geography_key", "customer_key")
    )
    several = (
        rows.groupBy("order_id", "anio", "mes")
        .agg(
            F.min("customer_key").alias("c0"), F.max("customer_key").alias("c1"),
            F.min("ship_geography_key").alias("g0"), F.max("ship_geography_key").alias("g1"),
        )
        .filter("c0 <> c1 OR g0 <> g1")
        .select("order_id", "anio", "mes")
    )
    found = rows.join(several, ["order_id", "anio", "mes"], "left_semi").distinct()
    return found.withColumn(MONTH, (F.col("anio") * 100 + F.col("mes")).cast("int"))


def dp01_from_state(
    state: DataFrame, divided: DataFrame, dim_geography: DataFrame, dim_customer: DataFrame,
    scores: DataFrame,
) -> DataFrame:
    """``dp01_sales_geo_score`` from the state of all months, without the fact. A customer
    whose score changed is in another segment by the join alone."""
    places, segments = _places(dim_geography), _segments(dim_customer, scores)

    def celled(rows: DataFrame) -> DataFrame:
        return rows.join(places, "ship_geography_key").join(segments, "customer_key")

    again = (
        celled(divided).groupBy("order_id", *CELL).agg((F.count("*") - 1).alias("again"))
        .filter("again > 0").groupBy(*CELL).agg(F.sum("again").alias("again"))
    )
    sums = [F.sum(c).alias(c) for c in ("ordenes", *_SUMS)]
    cells = (
        celled(state).groupBy(*CELL, "customer_key").agg(*sums)
        .groupBy(*CELL).agg(F.count("*").alias("clientes_distintos"), *sums)
    )
    a, b = cells.alias("a"), again.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in CELL]
    counted = a.join(b, same, "left").select(
        "a.*", (F.col("ordenes") - F.coalesce("again", F.lit(0))).alias("counted")
    )
    return _published(counted.drop("ordenes").withColumnRenamed("counted", "ordenes"), dim_geography)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def dp02_checks(checks: DataFrame) -> DataFrame:
    keys = ["nombre_script", "tabla", "columna", "tipo_chequeo", "resultado"]
    return checks.groupBy(*keys).agg(
        F.count("*").alias("checks"),
        _total("registros_afectados").alias("registros_afectados_total"),
        F.max("indicador_calculado").alias("indicador_maximo"),
        F.max("umbral_aplicado").alias("umbral_maximo"),
        F.max("fecha").alias("ultima_fecha"),
    )


def dp02_step_checks(checks: DataFrame, step: str) -> DataFrame:
    """Summary of the last batch of one step, to replace its rows in the product."""
    own = checks.filter(F.col("nombre_script") == step)
    return dp02_checks(own.filter(F.col("fecha") == own.select(F.max("fecha")).scalar()))


def dp02_events(events: DataFrame) -> DataFrame:
    return events.groupBy("nombre_script", "tabla", "tipo_evento", "estado").agg(
        F.count("*").alias("eventos"),
        _total("registros_procesados").alias("registros_procesados_total"),
        F.min("fecha_inicio").alias("primera_ejecucion"),
        F.max("fecha_fin").alias("ultima_ejecucion"),
    )


def dp02_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("tabla").agg(
        F.count_distinct("columna").alias("columnas_perfiladas"),
        F.max("total_filas").alias("total_filas_maximo"),
        _total("nulos").alias("nulos_total"),
        _total("valores_distintos").alias("valores_distintos_total"),
        _total("outliers_detectados").alias("outliers_total"),
        F.max("fecha").alias("ultima_fecha"),
    )


def dp02_profiles_or_default(profiles: DataFrame, now: Column) -> DataFrame:
    """The summary, or one row that says there is no profile."""
    summary = dp02_profiles(profiles)
    zeros = [F.lit(0).cast("bigint").alias(c) for c in summary.columns[1:-1]]
    default = profiles.sparkSession.range(1).select(
        F.lit(NO_PROFILE).alias("tabla"), *zeros, now.alias("ultima_fecha")
    )
    return or_default(summary, default)
