"""Gates: they raise, and so stop a load, when the check log does not allow it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.operators.checks import ERROR
from silostar.operators.ranking import latest

_KEYS = ("nombre_script", "tabla", "columna", "tipo_chequeo")


def _reject(current: DataFrame, what: str) -> None:
    """Raise with the failing checks (at most one per declared rule)."""
    failed = current.filter(F.col("resultado") == ERROR).select(
        F.concat(
            "tabla", F.lit("."), F.coalesce("columna", F.lit("*")), F.lit(" ["), "tipo_chequeo",
            F.lit("]: "), F.coalesce("detalle", F.lit("")),
        ).alias("text")
    )
    texts = sorted(r.text for r in failed.collect())
    if texts:
        raise RuntimeError(f"{what}: {len(texts)} check(s) in ERROR. " + "; ".join(texts))


def gate_tables(checks: DataFrame, tables: Sequence[str], steps: Sequence[str] = ()) -> None:
    """Every table has been checked and the latest result of each check is not ERROR."""
    relevant = checks.filter(F.col("tabla").isin(*tables))
    if steps:
        relevant = relevant.filter(F.col("nombre_script").isin(*steps))
    current = latest(relevant, _KEYS)
    _reject(current, "load refused")
    seen = {r.tabla for r in relevant.select("tabla").distinct().collect()}
    missing = sorted(set(tables) - seen)
    if missing:
        raise RuntimeError(f"load refused: never checked: {', '.join(missing)}")


def latest_status(checks: DataFrame) -> DataFrame:
    """How many checks there are by their latest result, and how many are in ERROR."""
    return latest(checks).agg(
        F.count("*").alias("total"), F.count_if(F.col("resultado") == ERROR).alias("errores")
    )


def gate_step(checks: DataFrame, step: str, required: int) -> None:
    """At least ``required`` checks of a step exist and none is in ERROR by its latest result."""
    own = checks.filter(F.col("nombre_script") == step)
    status = latest_status(own).first()
    if status.total < required:
        raise RuntimeError(f"load refused: {step} has {status.total} of {required} checks")
    _reject(latest(own), "load refused")


def gate_empty(target: DataFrame, table: str) -> None:
    """The target holds no rows yet."""
    if not target.isEmpty():
        raise RuntimeError(f"load refused: {table} already holds rows")
