"""Connected components of a link table, as alternating large and small stars.

Each round every node hangs its larger (then its smaller) neighbours on the smallest one it
knows, until the links are stars. Only groupings, joins and written tables: no link or
component passes the driver, and a node with very many links is combined per task in the
groupings and split in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import discard, stored


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    larger = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """``links`` run from the larger to the smaller node."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter(F.col("v") > F.col("m"))
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _signature(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node), for every node that has a link: a stored table.

    Nodes are of any type with an order. Links may repeat, in either direction; links of a
    node to itself and links with a null are dropped.
    """
    links = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("x"), F.col(b).alias("y")
    ).filter(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("u") != F.col("v")))
    links = stored(links.select("u", "v").distinct(), "links")
    before = _signature(links)
    while before[0]:
        earlier, links = links, stored(_small(_large(links)), "links")
        discard(earlier)
        after = _signature(links)
        if after == before:
            break
        before = after
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
    found = stored(found, "components")
    discard(links)
    return found
