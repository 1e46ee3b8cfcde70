"""Data-quality checks as declarative rules.

Every check gives one row. All rules that look at rows of one table are evaluated in one
scan of it, as one aggregate without a shuffle; duplicate and foreign-key rules add one
narrow scan of their key columns each, pre-aggregated per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silostar.functions.columns import (
    INTEGER_PATTERN,
    NUMERIC_PATTERN,
    SEGMENT_NONE,
    TIMESTAMP_PATTERN,
    blank_to_null,
    not_matches,
)
from silostar.model import CHECK_SCHEMA, ForeignKey, Source
from silostar.operators.history import timestamp
from silostar.operators.ranking import latest

# Check types and results --------------------------------------
INTEGER_FORMAT = "FORMATO_ENTERO"
NUMERIC_FORMAT = "FORMATO_NUMERICO"
TIMESTAMP_FORMAT = "FORMATO_TIMESTAMP"
NOT_NULL = "NOT_NULL"
KEY_NULLS = "PK_NULOS"
KEY_DUPLICATES = "PK_DUPLICADOS"
FOREIGN_KEY = "FK_INTEGRIDAD"
NO_EARLIER_ERRORS = "DWA_SIN_ERRORES_PREVIOS"
SOURCE_NOT_EMPTY = "DWA_FUENTE_NO_VACIA"
DIMENSION_JOIN = "DWA_JOIN_DIMENSION"
REQUIRED_DATE = "DWA_FECHA_REQUERIDA"
REQUIRED_PLACE = "DWA_GEOGRAFIA_REQUERIDA"
FACT_GRAIN = "DWA_GRANO_FACT"
VALID_MEASURE = "DWA_MEDIDA_VALIDA"
VALID_STOCK = "DWA_STOCK_VALIDO"
FACT_COUNT = "DWA_CONTEO_FACT"
SALES_NOT_EMPTY = "DP01_NO_VACIO"
SALES_SCORED = "DP01_SCORE_ENRIQUECIDO"
SALES_PLACED = "DP01_GEOGRAFIA_ENRIQUECIDA"
SALES_MEASURES = "DP01_MEDIDAS_VALIDAS"
QUALITY_NOT_EMPTY = "DP02_NO_VACIO"
LOG_WITHOUT_ERRORS = "DQM_SIN_ERRORES_PREVIOS"

OK, ERROR = "OK", "ERROR"
THRESHOLD = 0.0
ROWS_A_TASK = 500_000  # keys that one task groups, where rows are dealt out for it
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    check_type: str
    table: str
    columns: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    parent_column: str | None = None

    @property
    def label(self) -> str | None:
        if self.check_type == FOREIGN_KEY:
            return f"{self.columns[0]} → {self.parents[0]}.{self.parent_column}"
        if self.check_type == DIMENSION_JOIN:
            return f"{self.columns[0]} -> {self.parents[0]}.{self.parent_column}"
        return "|".join(self.columns) or None


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# Rules on single rows: condition that makes a row count as affected.
def _single(condition: Callable[[Column], Column]) -> Callable[..., Column]:
    return lambda *columns: condition(F.col(columns[0]))


def _bad_measure(price: str, quantity: str, discount: str) -> Column:
    q, d = F.col(quantity), F.col(discount)
    missing = _any(F.col(c).isNull() for c in (price, quantity, discount))
    return missing | (q <= 0) | (d < 0) | (d > 1)


def _bad_stock(*columns: str) -> Column:
    return _any(F.col(c).isNull() | (F.col(c) < 0) for c in columns)


def _bad_sales(orders: str, lines: str, quantity: str, net: str) -> Column:
    return _any(F.col(c) <= 0 for c in (orders, lines, quantity)) | (F.col(net) < 0)


ROW_RULES: dict[str, Callable[..., Column]] = {
    INTEGER_FORMAT: _single(lambda c: not_matches(c, INTEGER_PATTERN)),
    NUMERIC_FORMAT: _single(lambda c: not_matches(c, NUMERIC_PATTERN)),
    TIMESTAMP_FORMAT: _single(lambda c: not_matches(c, TIMESTAMP_PATTERN)),
    NOT_NULL: _single(lambda c: c.isNull()),
    KEY_NULLS: _single(lambda c: c.isNull()),
    REQUIRED_DATE: _single(lambda c: c.isNull()),
    REQUIRED_PLACE: _single(lambda c: blank_to_null(c.cast("string")).isNull()),
    VALID_MEASURE: _bad_measure,
    VALID_STOCK: _bad_stock,
    SALES_PLACED: lambda *columns: _any(F.col(c).isNull() for c in columns),
    SALES_MEASURES: _bad_sales,
}

# Rules on the table as a whole: condition on an aggregate, one of one if it holds.
TABLE_RULES: dict[str, Callable[..., Column]] = {
    SOURCE_NOT_EMPTY: lambda *columns: F.count("*") == 0,
    SALES_NOT_EMPTY: lambda *columns: F.count("*") == 0,
    SALES_SCORED: lambda segment: F.count_if(F.col(segment) != SEGMENT_NONE) == 0,
}

KEY_RULES = {KEY_DUPLICATES, FACT_GRAIN}
PARENT_RULES = {FOREIGN_KEY, DIMENSION_JOIN}


def _measured(df: DataFrame, rule: Rule, total: Column, affected: Column) -> DataFrame:
    return df.select(*_measurement(rule, total, affected))


def _measurement(rule: Rule, total: Column, affected: Column) -> list[Column]:
    return [
        F.lit(rule.table).alias("tabla"),
        F.lit(rule.label).cast("string").alias("columna"),
        F.lit(rule.check_type).alias("tipo_chequeo"),
        total.cast("bigint").alias("total"),
        affected.cast("bigint").alias("affected"),
    ]


def _scan(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All single-row and whole-table rules of one table in one aggregate."""
    counts = [F.count("*").alias("_rows")]
    rows = []
    for i, rule in enumerate(rules):
        if rule.check_type in ROW_RULES:
            counts.append(F.count_if(ROW_RULES[rule.check_type](*rule.columns)).alias(f"_{i}"))
            total = F.col("_rows")
        else:
            holds = TABLE_RULES[rule.check_type](*rule.columns)
            counts.append(F.when(holds, 1).otherwise(0).alias(f"_{i}"))
            total = F.lit(1)
        rows.append(F.struct(*_measurement(rule, total, F.col(f"_{i}"))))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df``, of ``rows`` rows at most, with equal keys in one task and so many tasks that
    the memory to group them does not grow with the table."""
    return df.repartition(max(1, -(-rows // ROWS_A_TASK)), *keys)


def measure_duplicates(df: DataFrame, rule: Rule, rows: int | None = None) -> DataFrame:
    """total, affected: rows, and rows beyond the first of each key. A single key column
    leaves nulls out; in a composite key null is a value like any other.

    Rows are counted per key before they move. After a join that dealt them by a part of the
    key, its tasks would hold all their keys twice: given how many ``rows`` there are at most,
    the rows are dealt out by the whole key first."""
    keys = list(rule.columns)
    if rule.check_type == KEY_DUPLICATES and len(keys) == 1:
        df = df.filter(F.col(keys[0]).isNotNull())
    if rows is not None:
        df = dealt(df.select(*keys), keys, rows)
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("affected"),
    )


def _duplicates(df: DataFrame, rule: Rule) -> DataFrame:
    return _measured(measure_duplicates(df, rule), rule, F.col("total"), F.col("affected"))


def measure_orphans(child: DataFrame, parents: Sequence[DataFrame], rule: Rule) -> DataFrame:
    """total, affected: child rows, and those with a key that no parent has. Counting per
    child key first means a hot key crosses the shuffle as one row; distinct parent keys keep
    the total right."""
    fk, pk = rule.columns[0], rule.parent_column
    fk_type = child.schema[fk].dataType
    same = all(p.schema[pk].dataType == fk_type for p in parents)
    as_key = (lambda c: c) if same else (lambda c: c.cast("string"))

    keys = reduce(DataFrame.union, [p.select(as_key(F.col(pk)).alias("_key")) for p in parents])
    known = keys.distinct().withColumn("_known", F.lit(True))
    counted = child.select(as_key(F.col(fk)).alias("_key")).groupBy("_key").agg(
        F.count("*").alias("_n")
    )
    orphan = F.col("_key").isNotNull() & F.col("_known").isNull()
    return counted.join(known, "_key", "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("affected"),
    )


def _orphans(child: DataFrame, parents: Sequence[DataFrame], rule: Rule) -> DataFrame:
    return _measured(measure_orphans(child, parents, rule), rule, F.col("total"), F.col("affected"))


def finish(measured: DataFrame, batch_ts: datetime, step: str) -> DataFrame:
    """Indicator, result and text of measured rules. The result depends on the affected
    rows alone: tolerance is zero."""
    total, affected = F.col("total"), F.col("affected")
    where = F.concat_ws(".", "tabla", "columna")
    return measured.select(
        "tabla",
        "columna",
        "tipo_chequeo",
        F.lit(step).alias("nombre_script"),
        timestamp(batch_ts).alias("fecha"),
        total.alias("total_filas_evaluadas"),
        affected.alias("registros_afectados"),
        F.when(total > 0, affected.cast("double") / total).otherwise(0.0).alias(
            "indicador_calculado"
        ),
        F.lit(THRESHOLD).alias("umbral_aplicado"),
        F.when(affected == 0, OK).otherwise(ERROR).alias("resultado"),
        F.concat(
            "tipo_chequeo", F.lit(" "), where, F.lit(": "), affected.cast("string"),
            F.lit(" / "), total.cast("string"),
        ).alias("detalle"),
    )


def run_checks(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], batch_ts: datetime, step: str
) -> DataFrame:
    """One row per rule, over the whole of every table."""
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table]
        scanned = [r for r in own if r.check_type in ROW_RULES or r.check_type in TABLE_RULES]
        if scanned:
            parts.append(_scan(tables[table], scanned))
        for rule in own:
            if rule.check_type in KEY_RULES:
                parts.append(_duplicates(tables[table], rule))
            elif rule.check_type in PARENT_RULES:
                parts.append(_orphans(tables[table], [tables[p] for p in rule.parents], rule))
            elif rule not in scanned:
                raise ValueError(f"unknown check type: {rule.check_type}")
    return finish(reduce(DataFrame.unionByName, parts), batch_ts, step)


def results_of(parts: DataFrame, rule: Rule, batch_ts: datetime, step: str) -> DataFrame:
    """The result row of a rule from the figures (total, affected) of parts of a table."""
    whole = parts.agg(F.sum("total").alias("total"), F.sum("affected").alias("affected"))
    return finish(_measured(whole, rule, F.col("total"), F.col("affected")), batch_ts, step)


def measured_results(
    spark: SparkSession, figures: Sequence[tuple[Rule, int, int]], batch_ts: datetime, step: str
) -> DataFrame:
    """Result rows of rules that were measured before: (rule, total, affected)."""
    rows = [(r.table, r.label, r.check_type, total, affected) for r, total, affected in figures]
    types = "tabla string, columna string, tipo_chequeo string, total bigint, affected bigint"
    return finish(spark.createDataFrame(rows, types), batch_ts, step)


# Checks that compare tables or read the check log ---------------------------
def row_reconciliation(
    fact: DataFrame, source: DataFrame, table: str, batch_ts: datetime, step: str
) -> DataFrame:
    """Difference between the rows of a fact and of its source."""
    counts = source.agg(F.count("*").alias("_source")).withColumn(
        "_fact", fact.select(F.count("*")).scalar()
    )
    rule = Rule(FACT_COUNT, table)
    difference = F.abs(F.col("_fact") - F.col("_source"))
    return finish(_measured(counts, rule, F.col("_source"), difference), batch_ts, step)


def empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the tables without rows."""
    counts = [
        df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).filter(F.col("filas") == 0)


def tables_not_empty(
    tables: Mapping[str, DataFrame], label: str, batch_ts: datetime, step: str
) -> DataFrame:
    """Empty tables among several."""
    counted = empty_tables(tables).agg(F.count("*").alias("_empty"))
    rule = Rule(QUALITY_NOT_EMPTY, label)
    return finish(
        _measured(counted, rule, F.lit(len(tables)), F.col("_empty")), batch_ts, step
    )


def earlier_errors(
    checks: DataFrame, steps: Sequence[str], batch_ts: datetime, step: str, table: str = "DWA"
) -> DataFrame:
    """ERROR among the latest results of earlier steps. No result at all is one error of one."""
    current = latest(
        checks.filter(F.col("nombre_script").isin(*steps)),
        ("nombre_script", "tabla", "columna", "tipo_chequeo"),
    )
    counts = current.agg(
        F.count("*").alias("_all"), F.count_if(F.col("resultado") == ERROR).alias("_bad")
    )
    none = F.col("_all") == 0
    return finish(
        _measured(
            counts, Rule(NO_EARLIER_ERRORS, table),
            F.when(none, 1).otherwise(F.col("_all")), F.when(none, 1).otherwise(F.col("_bad")),
        ),
        batch_ts, step,
    )


def log_without_errors(
    checks: DataFrame, batch_ts: datetime, step: str, table: str = "dqm_validaciones"
) -> DataFrame:
    """ERROR among the latest results of all other steps."""
    current = latest(
        checks.filter(F.col("nombre_script") != step),
        ("nombre_script", "tabla", "columna", "tipo_chequeo"),
    )
    counts = current.agg(F.count_if(F.col("resultado") == ERROR).alias("_bad"))
    rule = Rule(LOG_WITHOUT_ERRORS, table, ("resultado",))
    return finish(
        _measured(counts, rule, F.greatest(F.col("_bad"), F.lit(1)), F.col("_bad")),
        batch_ts, step,
    )


def errors_by_table(checks: DataFrame) -> DataFrame:
    """Failed checks per table."""
    return (
        checks.filter(F.col("resultado") == ERROR)
        .groupBy("tabla")
        .agg(F.count("*").alias("errores"))
    )


# Rule lists derived from the declared inputs --------------------------------
_FORMAT_BY_CAST = {
    "bigint": INTEGER_FORMAT,
    "int": INTEGER_FORMAT,
    "decimal": NUMERIC_FORMAT,
    "timestamp_ntz": TIMESTAMP_FORMAT,
}


def raw_rules(source: Source) -> list[Rule]:
    """Formats of the columns to be cast, required columns, key nulls and duplicates."""
    table = source.raw_table
    formats = [
        Rule(_FORMAT_BY_CAST[cast.split("(")[0]], table, (c,)) for c, cast in source.casts.items()
    ]
    required = [Rule(NOT_NULL, table, (c,)) for c in source.not_null]
    keys = [Rule(KEY_NULLS, table, (c,)) for c in source.key]
    return [*formats, *required, *keys, Rule(KEY_DUPLICATES, table, source.key)]


def foreign_key_rules(keys: Iterable[ForeignKey]) -> list[Rule]:
    return [
        Rule(
            FOREIGN_KEY, f"tmp_{k.child}", (k.column,),
            tuple(f"tmp_{p}" for p in k.parents), k.parent_column,
        )
        for k in keys
    ]


def warehouse_rules() -> list[Rule]:
    """Checks on the staged tables before the warehouse is loaded (with
    ``earlier_errors`` they are 16)."""
    orders, lines = "tmp_orders", "tmp_order_details"
    joins = [
        (orders, "customer_id", "tmp_customers", "customer_id"),
        (orders, "employee_id", "tmp_employees", "employee_id"),
        (orders, "ship_via", "tmp_shippers", "shipper_id"),
        (lines, "order_id", orders, "order_id"),
        (lines, "product_id", "tmp_products", "product_id"),
    ]
    return list(
        chain(
            [Rule(SOURCE_NOT_EMPTY, t) for t in (orders, lines)],
            [Rule(DIMENSION_JOIN, c, (fk,), (p,), pk) for c, fk, p, pk in joins],
            [Rule(REQUIRED_DATE, orders, (c,)) for c in ("order_date", "required_date")],
            [
                Rule(REQUIRED_PLACE, "tmp_customers", ("country",)),
                Rule(REQUIRED_PLACE, "tmp_employees", ("country",)),
                Rule(REQUIRED_PLACE, orders, ("ship_country",)),
                Rule(FACT_GRAIN, lines, ("order_id", "product_id")),
                Rule(VALID_MEASURE, lines, ("unit_price", "quantity", "discount")),
                Rule(
                    VALID_STOCK, "tmp_products",
                    ("units_in_stock", "units_on_order", "reorder_level"),
                ),
            ],
        )
    )


def fact_rules(fact: str, dimensions: Mapping[str, str]) -> list[Rule]:
    """Checks on a loaded fact: its grain, and that each key is in its dimension
    (``dimensions``: table by key name). They can be measured load by load."""
    grain = Rule(FACT_GRAIN, fact, ("order_id", "product_id"))
    columns = {
        "customer_key": "customer", "product_key": "product", "employee_key": "employee",
        "shipper_key": "shipper", "ship_geography_key": "geography", "order_date_key": "date",
    }
    return [grain] + [
        Rule(DIMENSION_JOIN, fact, (column,), (dimensions[name],), f"{name}_key")
        for column, name in columns.items()
    ]


def sales_rules(table: str = "dp01_ventas_geo_score") -> list[Rule]:
    """Checks on the published sales product."""
    return [
        Rule(SALES_NOT_EMPTY, table),
        Rule(SALES_SCORED, table, ("score_segment",)),
        Rule(
            SALES_PLACED, table,
            ("country_iso_code", "country_currency", "country_latitude", "country_longitude"),
        ),
        Rule(SALES_MEASURES, table, ("ordenes", "lineas_orden", "cantidad_total", "net_amount")),
    ]


CHECK_COLUMNS = [f.name for f in CHECK_SCHEMA if f.name != "id"]
