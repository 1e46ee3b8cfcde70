"""State kept beside the tables, so that a load costs what it brings and not what is there.

| State | Kept per | Brought up to date by |
|---|---|---|
| metric partials and totals | customer and order, product and order | the lines of a delta |
| sales state | month, place and customer | the months that got lines |
| partial profiles | folders of a table | the folders not profiled yet |
| marks of checks | folders of a table | the folders not measured yet |
| latest checks | check | each batch of results |

All of it can be dropped: it is then worked out again from the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silostar import model
from silostar.operators import increments
from silostar.operators.checks import PARENT_RULES, Rule, measured_results
from silostar.operators.keys import assign_keys
from silostar.operators.profile import PARTIAL_TYPES, merged_profile, partial_profile
from silostar.operators.pruning import key_ranges, within
from silostar.operators.ranking import first_per_key
from silostar.plans import metrics, publication
from silostar.sources.tables import Warehouse

# Tables of state ------------------------------------------------
CUSTOMER_ORDERS, CUSTOMER_TOTALS = "dwm_estado_cliente_orden", "dwm_estado_cliente"
PRODUCT_ORDERS, PRODUCT_TOTALS = "dwm_estado_producto_orden", "dwm_estado_producto"
PENDING_CUSTOMERS, PENDING_PRODUCTS = "dwm_pendiente_cliente", "dwm_pendiente_producto"
SALES_STATE, DIVIDED_ORDERS = "dwm_estado_ventas", "dwm_estado_ordenes_divididas"
PENDING_MONTHS = "dwm_pendiente_meses"
PARTIALS = "dqm_perfilado_parcial"
MARKS = "dqm_marcas_chequeo"
CHECKS, LATEST_CHECKS = "dqm_validaciones", "dqm_ultimos_chequeos"
# ----------------------------------------------------------------------------

FACT_PARTITIONS = ("order_year", "order_month")
# A file of a table laid out by order holds about so many rows.
ROWS_PER_FILE = 2_000_000
# Loads whose partials are kept apart before they are merged into one.
MOST_LOADS = 50
CHECK_KEY = ("nombre_script", "tabla", "columna", "tipo_chequeo")
_MONTH_TYPES = f"{publication.MONTH} int"
_GROUPS = "tabla string, grupo string, carpetas array<string>, " + PARTIAL_TYPES


def by_order(df: DataFrame, *first: str) -> DataFrame:
    """``df``, a written table, laid out by ranges of ``first`` and the order, so that a scan
    for some orders skips the other files and row groups. The number of files follows the
    rows; an order that holds much of the table is cut by its second key."""
    keys = [*first, "order_id", *[c for c in ("product_id", "product_key", "customer_key") if c in df.columns][:1]]
    files = df.count() // ROWS_PER_FILE + 1
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


# Metrics --------------------------------------------------------------------
def rebuild_metric_totals(
    wh: Warehouse, fact: DataFrame, dim_date: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """All partials and totals from the fact. Returns the totals of customers and products."""
    customers = wh.intermediate(metrics.customer_orders(fact))
    wh.overwrite(by_order(customers), CUSTOMER_ORDERS)
    wh.overwrite(metrics.customer_totals(customers, dim_date), CUSTOMER_TOTALS)
    products = wh.intermediate(metrics.product_orders(fact, dim_date))
    wh.overwrite(by_order(products), PRODUCT_ORDERS)
    wh.overwrite(metrics.product_totals(products), PRODUCT_TOTALS)
    for table in (PENDING_CUSTOMERS, PENDING_PRODUCTS):
        wh.drop(table)
    return wh.read(CUSTOMER_TOTALS), wh.read(PRODUCT_TOTALS)


def note_new_lines(wh: Warehouse, fresh: DataFrame, dim_date: DataFrame) -> None:
    """What new lines of the fact add, for the next refresh of the metrics and products."""
    wh.append(metrics.customer_orders(fresh), PENDING_CUSTOMERS)
    wh.append(metrics.product_orders(fresh, dim_date), PENDING_PRODUCTS)
    day = F.col("order_date_key")
    months = fresh.filter(day.isNotNull()).select(F.floor(day / 100).cast("int").alias(publication.MONTH))
    wh.append(months.distinct().coalesce(1), PENDING_MONTHS)


def has_metric_state(wh: Warehouse) -> bool:
    return all(map(wh.exists, (CUSTOMER_ORDERS, CUSTOMER_TOTALS, PRODUCT_ORDERS, PRODUCT_TOTALS)))


def _pending(wh: Warehouse, pending: str, state: str, keys: Sequence[str], merged) -> tuple[DataFrame, DataFrame]:
    """The merged new partials, and the merged stored ones of the same keys: found within
    the ranges of the new orders."""
    touched = wh.intermediate(merged(wh.read(pending)))
    stored = wh.read(state).filter(within("order_id", key_ranges(touched, "order_id")))
    same = stored.join(touched.select(*keys), list(keys), "left_semi")
    return touched, wh.intermediate(merged(same))


def _keep(wh: Warehouse, touched: DataFrame, state: str, merged) -> None:
    wh.append(by_order(touched), state)
    if len(wh.folders(state)) > MOST_LOADS:
        wh.overwrite(by_order(wh.intermediate(merged(wh.read(state)))), state)


def _replace_rows(wh: Warehouse, updated: DataFrame, table: str, key: str) -> None:
    others = wh.read(table).join(updated.select(key), key, "left_anti")
    wh.overwrite(others.unionByName(updated), table)


def refresh_customer_totals(wh: Warehouse, dim_date: DataFrame) -> DataFrame | None:
    """Totals of the customers that got lines, worked out from state alone; none if there
    are no new lines."""
    if not wh.exists(PENDING_CUSTOMERS):
        return None
    merged = metrics.merged_customer_orders
    touched, before = _pending(wh, PENDING_CUSTOMERS, CUSTOMER_ORDERS, metrics.CUSTOMER_ORDER, merged)
    updated, moved = metrics.updated_customer_totals(wh.read(CUSTOMER_TOTALS), touched, before, dim_date)
    moved = wh.intermediate(moved)
    _keep(wh, touched, CUSTOMER_ORDERS, merged)
    if not moved.isEmpty():
        orders = merged(wh.read(CUSTOMER_ORDERS).join(moved, "customer_key", "left_semi"))
        again = metrics.customer_totals(orders, dim_date).select(*updated.columns)
        updated = updated.join(moved, "customer_key", "left_anti").unionByName(again)
    updated = wh.intermediate(updated)
    _replace_rows(wh, updated, CUSTOMER_TOTALS, "customer_key")
    wh.drop(PENDING_CUSTOMERS)
    return updated


def refresh_product_totals(wh: Warehouse) -> DataFrame | None:
    if not wh.exists(PENDING_PRODUCTS):
        return None
    merged = metrics.merged_product_orders
    touched, known = _pending(wh, PENDING_PRODUCTS, PRODUCT_ORDERS, metrics.PRODUCT_ORDER, merged)
    updated = wh.intermediate(metrics.updated_product_totals(wh.read(PRODUCT_TOTALS), touched, known))
    _keep(wh, touched, PRODUCT_ORDERS, merged)
    _replace_rows(wh, updated, PRODUCT_TOTALS, "product_key")
    wh.drop(PENDING_PRODUCTS)
    return updated


# Sales product --------------------------------------------------------------
def of_months(fact: DataFrame, months: Sequence[int]) -> DataFrame:
    """The fact's partitions of the given months (year and month in one number)."""
    year, month = FACT_PARTITIONS
    parts = [(F.col(year) == m // 100) & (F.col(month) == m % 100) for m in months]
    return fact.filter(reduce(or_, parts) if parts else F.lit(False))


def drop_sales_state(wh: Warehouse) -> None:
    for table in (SALES_STATE, DIVIDED_ORDERS, PENDING_MONTHS):
        wh.drop(table)


def refresh_sales_state(wh: Warehouse, fact: DataFrame, dim_date: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bring the sales state up to date: all of it the first time, then the months that got
    lines, of which only the fact's partitions are read. Returns it and the divided orders."""
    pending = wh.read(PENDING_MONTHS, StructType.fromDDL(_MONTH_TYPES))
    whole = not wh.exists(SALES_STATE)
    months = sorted(r[0] for r in pending.distinct().collect())  # a row per month of a calendar
    part = fact if whole else of_months(fact, months)
    state, divided = publication.sales_state(part, dim_date), publication.divided_orders(part, dim_date)
    if whole or months:
        wh.replace_where(state, SALES_STATE, publication.MONTH, whole)
        wh.replace_where(divided, DIVIDED_ORDERS, publication.MONTH, whole)
        wh.drop(PENDING_MONTHS)
    return wh.read(SALES_STATE, state.schema), wh.read(DIVIDED_ORDERS, divided.schema)


# Profiles -------------------------------------------------------------------
def refresh_profiles(
    wh: Warehouse, columns: Mapping[str, Sequence[str]], ts: datetime, step: str, table_row: bool
) -> DataFrame:
    """Profiles of tables merged from partial ones per group of folders. Only folders that
    no partial covers are scanned, once; partials of folders that are gone are deleted."""
    schema = StructType.fromDDL(_GROUPS)
    known = wh.read(PARTIALS, schema).filter(F.col("tabla").isin(*columns))
    groups = known.groupBy("tabla", "grupo").agg(
        F.first("carpetas").alias("carpetas"), F.collect_set("columna").alias("columnas")
    )
    usable: dict[str, list[str]] = {t: [] for t in columns}
    covered: dict[str, set[str]] = {t: set() for t in columns}
    for r in groups.collect():  # a row per table and load
        if set(r.carpetas) <= set(wh.folders(r.tabla)) and set(columns[r.tabla]) <= set(r.columnas):
            usable[r.tabla].append(r.grupo)
            covered[r.tabla] |= set(r.carpetas)
    fresh = []
    for table, names in columns.items():
        rest = [f for f in wh.folders(table) if f not in covered[table]]
        if rest:
            paths = F.array(*map(F.lit, rest))
            part = partial_profile(wh.read(table, only=rest), names)
            fresh.append(part.select(
                F.lit(table).alias("tabla"), F.lit(uuid.uuid4().hex).alias("grupo"), paths.alias("carpetas"), "*"
            ))
    if fresh:
        kept = known.filter(F.col("grupo").isin(*[g for found in usable.values() for g in found] or [""]))
        rows = wh.intermediate(reduce(DataFrame.unionByName, fresh))
        touched = kept.join(rows.select("tabla").distinct(), "tabla", "left_semi")
        wh.replace_where(touched.unionByName(rows).select(*schema.names), PARTIALS, "tabla")
    found = wh.read(PARTIALS, schema)
    parts = [
        merged_profile(found.filter(F.col("tabla") == t), wh.read(t), t, names, ts, step, table_row)
        for t, names in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Checks ---------------------------------------------------------------------
def check_new_folders(wh: Warehouse, rules: Sequence[Rule], ts: datetime, step: str) -> DataFrame:
    """Results of duplicate and foreign-key rules on stored tables, where only folders that
    no mark covers are measured. The results are those of the full check."""
    stored = wh.read(MARKS, increments.MARK_SCHEMA)
    marks = increments.marks_of(stored)
    figures, rows, tables = [], [], {r.table for r in rules}
    for rule in rules:
        above = [f for p in rule.parents for f in wh.folders(p)] if rule.check_type in PARENT_RULES else []
        kept, fresh = increments.measure(
            rule, wh.folders(rule.table), marks.get((rule.table, rule.label, rule.check_type), []), above,
            lambda folders, t=rule.table: wh.read(t, only=folders),
            lambda r=rule: [wh.read(p) for p in r.parents],
        )
        now = [*kept, *([fresh] if fresh else [])]
        rows += increments.mark_rows(rule, now)
        figures.append((rule, sum(m.total for m in now), sum(m.affected for m in now)))
    asked = [(r.table, r.label, r.check_type) for r in rules]
    others = stored.filter(F.col("tabla").isin(*tables)).filter(
        ~reduce(or_, [(F.col("tabla") == t) & (F.col("columna") == c) & (F.col("tipo_chequeo") == k) for t, c, k in asked])
    )
    rows = wh.spark.createDataFrame(rows, increments.MARK_SCHEMA).unionByName(others)
    wh.replace_where(rows, MARKS, "tabla")
    return measured_results(wh.spark, figures, ts, step)


def keep_checks(wh: Warehouse, checked: DataFrame) -> int:
    """Append results to the log, and let them take the place of earlier results of the same
    checks: the latest time counts, then the highest id."""
    order = ["nombre_script", "tabla", "columna", "tipo_chequeo"]
    numbered = assign_keys(checked, order, "id", wh.highest(CHECKS), bucket_digits=1)
    rows = wh.intermediate(numbered.select(*[F.col(f.name).cast(f.dataType) for f in model.CHECK_SCHEMA]).coalesce(1))
    before = latest_checks(wh)
    wh.append(rows, CHECKS, key="id")
    latest = first_per_key(
        before.unionByName(rows), CHECK_KEY, [F.desc_nulls_first("fecha"), F.desc_nulls_first("id")]
    )
    wh.overwrite(latest.coalesce(1), LATEST_CHECKS)
    return rows.count()


def latest_checks(wh: Warehouse) -> DataFrame:
    """The latest result of every check of every step: a row per check. A warehouse without
    this state has it worked out from its log."""
    if wh.exists(LATEST_CHECKS):
        return wh.read(LATEST_CHECKS)
    log = wh.read(CHECKS, model.CHECK_SCHEMA)
    return first_per_key(log, CHECK_KEY, [F.desc_nulls_first("fecha"), F.desc_nulls_first("id")])
