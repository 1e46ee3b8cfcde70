"""Enrichment from outside files: country attributes and customer scores."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.functions.columns import blank_to_null
from silostar.model import COUNTRY_ALIASES, ISO_FALLBACK
from silostar.operators.history import timestamp
from silostar.operators.merge import ensure_columns, scd1_update, upsert
from silostar.operators.ranking import first_per_key

GEO_ATTRIBUTES = {
    "country_iso_code": "string",
    "country_capital": "string",
    "country_language": "string",
    "country_currency": "string",
    "country_latitude": "double",
    "country_longitude": "double",
}


def resolve_country(
    countries: DataFrame, aliases: Mapping[str, str] = COUNTRY_ALIASES
) -> DataFrame:
    """Country attributes under every name the warehouse uses: the own name and the aliases.
    An alias whose target exists goes before a record under the same name."""
    def entry(name: Column, is_alias: bool) -> Column:
        return F.struct(name.alias("name"), F.lit(is_alias).alias("is_alias"))

    own = entry(F.col("country"), False)
    others = [
        F.when(F.col("country") == target, entry(F.lit(alias), True))
        for alias, target in aliases.items()
    ]
    rest = [c for c in countries.columns if c != "country"]
    named = countries.select(F.explode(F.array_compact(F.array(own, *others))).alias("n"), *rest)
    named = named.select(F.col("n.name").alias("country"), *rest, "n.is_alias")
    return first_per_key(named, ["country"], [F.desc("is_alias")]).drop("is_alias")


def enrich_geography(
    geography: DataFrame, countries: DataFrame,
    aliases: Mapping[str, str] = COUNTRY_ALIASES, iso_fallback: Mapping[str, str] = ISO_FALLBACK,
) -> DataFrame:
    """Set the country attributes of every place whose country is known; others keep theirs.
    One join replaces an update per country."""
    named = resolve_country(countries, aliases)
    iso = blank_to_null("iso_code")
    for name, code in iso_fallback.items():
        iso = F.coalesce(iso, F.when(F.col("country") == name, code))
    attributes = named.select(
        "country",
        iso.alias("country_iso_code"),
        blank_to_null("capital").alias("country_capital"),
        blank_to_null("official_language").alias("country_language"),
        blank_to_null("currency_code").alias("country_currency"),
        blank_to_null("latitude").cast("double").alias("country_latitude"),
        blank_to_null("longitude").cast("double").alias("country_longitude"),
    )
    known = ensure_columns(geography, GEO_ATTRIBUTES)
    return scd1_update(known, attributes, ["country"], list(GEO_ATTRIBUTES))


def best_scores(scores: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The highest score of every known customer; blanks do not count."""
    present = scores.filter(F.col("score").isNotNull() & (F.col("score") != "")).select(
        "customer_id", F.col("score").cast("int").alias("score")
    )
    best = present.groupBy("customer_id").agg(F.max("score").alias("score"))
    return best.join(dim_customer.select("customer_id", "customer_key"), "customer_id").select(
        "customer_key", "customer_id", "score"
    )


def load_scores(target: DataFrame, best: DataFrame, batch_ts: datetime) -> DataFrame:
    """Insert new scores and overwrite known ones, with the time of the batch."""
    stamped = best.withColumn("fecha_carga", timestamp(batch_ts))
    return upsert(target, stamped, ["customer_id"], ["score", "fecha_carga"])
