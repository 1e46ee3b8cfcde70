"""Helpers shared by the operators: tables, written intermediates, settings for Arrow batches."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch. Texts may be very long, so that batches stay far below the default.
BATCH_ROWS = 400


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Only a session with a local master may leave it unset; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return _local_folder(spark.sparkContext.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


# Shuffle files go when the query that wrote them ends; its result is a table by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: it survives lost executors, is worked
    out once however often it is read, and its size is known to the planner. ``discard``
    deletes it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables after their last reader."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def key_text(key: str) -> Column:
    """A key on its way to Python, as text: numbers beside nulls would become doubles there
    and lose digits. ``typed`` takes it back."""
    return F.col(key).cast("string").alias("key")


def typed(df: DataFrame, like: DataFrame, key: str) -> DataFrame:
    """``df`` with its text column ``key`` in the type that it has in ``like``."""
    return df.withColumn("key", F.col("key").cast(like.schema[key].dataType))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark
