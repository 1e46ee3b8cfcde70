"""Report queries over the published products (all inputs are small aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silostar.functions.columns import segment_label
from silostar.operators.ranking import top



def kpis(dp01: DataFrame) -> DataFrame:
    """Headline figures. Orders add up because an order falls in one cell; distinct
    customers do not, so there is no total of them."""
    return dp01.agg(
        F.count("*").alias("filas_dp"),
        F.count_distinct("ship_country").alias("paises"),
        F.sum("ordenes").alias("ordenes"),
        F.sum("lineas_orden").alias("lineas"),
        F.sum("net_amount").alias("venta_neta"),
    )


def top_countries(dp01: DataFrame, n: int = 10) -> DataFrame:
    totals = dp01.groupBy("ship_country", "country_iso_code").agg(
        F.sum("ordenes").alias("ordenes"), F.sum("net_amount").alias("venta_neta")
    )
    order = [F.desc("venta_neta"), F.asc("ship_country"), F.asc("country_iso_code")]
    return top(totals, order, n)


def segments(dp01: DataFrame) -> DataFrame:
    return (
        dp01.groupBy("score_segment")
        .agg(
            F.min("score_segment_order").alias("orden"),
            F.sum("ordenes").alias("ordenes"),
            F.sum("net_amount").alias("venta_neta"),
        )
        .withColumn("score_segment_label", segment_label("score_segment"))
        .orderBy("orden")
    )


def monthly(dp01: DataFrame) -> DataFrame:
    return (
        dp01.groupBy("periodo")
        .agg(F.sum("ordenes").alias("ordenes"), F.sum("net_amount").alias("venta_neta"))
        .orderBy("periodo")
    )


def bar_width(df: DataFrame, value: str, name: str = "width") -> DataFrame:
    """Whole percentage of the highest value, at least 2. ``df`` holds the rows of a report
    (``top_countries``: ten), so the window over all of them is as small; a subquery would
    compute the report twice."""
    shown = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    highest = F.max(shown).over(Window.partitionBy())
    percent = shown / F.when(highest == 0, F.lit(1.0)).otherwise(highest) * 100
    return df.withColumn(name, F.greatest(F.lit(2), percent.cast("int")))


def check_status(dp02: DataFrame) -> DataFrame:
    return (
        dp02.groupBy("resultado")
        .agg(
            F.sum("checks").alias("checks"),
            F.sum("registros_afectados_total").alias("afectados"),
        )
        .orderBy("resultado")
    )


def event_status(dp02: DataFrame) -> DataFrame:
    return (
        dp02.groupBy("estado")
        .agg(
            F.sum("eventos").alias("eventos"),
            F.sum("registros_procesados_total").alias("procesados"),
        )
        .orderBy("estado")
    )


def top_profiles(dp02: DataFrame, n: int = 15) -> DataFrame:
    order = [F.desc_nulls_last("total_filas_maximo"), F.asc("tabla")]
    shown = ["tabla", "columnas_perfiladas", "total_filas_maximo", "nulos_total", "outliers_total"]
    return top(dp02.select(*shown), order, n)


def recent_checks(dp02: DataFrame, n: int = 15) -> DataFrame:
    order = [
        F.desc_nulls_last("ultima_fecha"), F.asc("nombre_script"), F.asc("tabla"),
        F.asc_nulls_first("columna"), F.asc("tipo_chequeo"), F.asc("resultado"),
    ]
    shown = [
        "nombre_script", "tabla", "tipo_chequeo", "resultado", "registros_afectados_total",
        "ultima_fecha",
    ]
    return top(dp02, order, n).select(*shown)
