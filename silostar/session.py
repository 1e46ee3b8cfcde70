"""Session settings and shared helpers."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import SparkSession

# Runtime settings every load and query relies on. Broadcasting is left to Spark's own
# size check (spark.sql.autoBroadcastJoinThreshold), with sort-merge joins beyond it.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for local runs; on a cluster pass the existing one to ``configure``."""
    builder = SparkSession.builder.appName("silostar")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config(
        "spark.sql.session.timeZone", "UTC"
    )
    return configure(builder.getOrCreate())


def batch_timestamp() -> datetime:
    """One UTC time per batch, passed to every step so that all its rows agree."""
    return datetime.now(UTC).replace(tzinfo=None)
