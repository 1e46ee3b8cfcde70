"""The loads from files to published products, step by step.

Each step reads tables of the warehouse, writes its results as snapshots or appends, and
logs an event per table written, all in one transaction: a step that fails has changed
nothing, and may be run again. A step that is run again after it was done adds nothing:
inserts leave out known keys and unchanged versions open nothing.

A gate lets data pass that was checked as it is now: each run of checks notes the version of
the tables that it looked at, and a table written since has to be checked again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silostar import model
from silostar.operators import checks as ck
from silostar.operators import gates
from silostar.operators.history import (
    scd2_changes,
    scd2_closed,
    scd2_init,
    scd2_open,
    timestamp,
)
from silostar.operators.keys import assign_keys
from silostar.operators.merge import insert_new, scd1_update
from silostar.operators.profile import profile
from silostar.operators.pruning import key_ranges
from silostar.plans import dashboard, enrichment, metrics, publication, star, upkeep
from silostar.plans.staging import to_typed
from silostar.plans.upkeep import FACT_PARTITIONS, by_order
from silostar.session import batch_timestamp
from silostar.sources.delimited import (
    read_country_attributes, read_scores, read_source, record_end,
)
from silostar.sources.tables import Warehouse, append_numbered, event, log_events

# Tables, event kinds and step names ---------------------------
EVENTS, CHECKS, PROFILES = "dqm_eventos", "dqm_validaciones", "dqm_perfilado"
CHECKED = "dqm_versiones_chequeadas"
CHANGES = "dwm_cambios"
DIM_DATE, DIM_GEOGRAPHY = "dwa_dim_date", "dwa_dim_geography"
DIM_CUSTOMER, DIM_PRODUCT = "dwa_dim_customer", "dwa_dim_product"
DIM_EMPLOYEE, DIM_SHIPPER = "dwa_dim_employee", "dwa_dim_shipper"
FACT = "dwa_fact_order_lines"
CUSTOMER_HISTORY, PRODUCT_HISTORY = "dwm_customer_history", "dwm_product_history"
CUSTOMER_METRICS = "dwa_enr_customer_sales_metrics"
PRODUCT_METRICS = "dwa_enr_product_sales_metrics"
RAW_COUNTRIES, RAW_SCORES = "txt_world_data", "txt_customer_score"
SCORES = "dwa_enr_customer_score"
SALES = "dp01_ventas_geo_score"
CHECK_SUMMARY = "dp02_dqm_validaciones_resumen"
EVENT_SUMMARY = "dp02_dqm_eventos_resumen"
PROFILE_SUMMARY = "dp02_dqm_perfilado_resumen"
DASHBOARDS = "tableros"

RAW_LOAD, STAGED_LOAD, WAREHOUSE_LOAD = "CARGA_TXT", "CARGA_TMP", "CARGA_DWA"
WAREHOUSE_UPDATE, ENRICHMENT = "ACTUALIZACION_DWA", "ENRIQUECIMIENTO"
PUBLICATION, DASHBOARD = "PUBLICACION_DP", "GENERACION_TABLERO"
REQUIRED_CHECKS = 16

SCORE_TYPES = "customer_key bigint, customer_id string, score int, fecha_carga timestamp_ntz"
GRAIN = ("order_id", "product_id")
FACT_BUCKET_DIGITS = 4  # the fact is the largest table: more, smaller buckets to number
# Parts of a history: a delta reads and writes the open versions, and appends closed ones.
OPEN, CLOSED = "open", "closed"
CHECKED_TYPES = "tabla string, nombre_script string, version bigint"
CHANGE_TYPES = "fecha timestamp_ntz, entidad string, clave string, cambio string"
# ----------------------------------------------------------------------------


class Recorder:
    """Writes tables of one step and keeps an event for each."""

    def __init__(self, wh: Warehouse, step: str, kind: str):
        self.wh, self.step, self.kind = wh, step, kind
        self.events: list[tuple] = []
        self.rows: dict[str, int] = {}

    def note(
        self, table: str, start: datetime, rows: int, note: str | None = None
    ) -> None:
        end = batch_timestamp()
        self.events.append(event(table, self.kind, self.step, start, end, rows, note=note))
        self.rows[table] = self.rows.get(table, 0) + rows

    def overwrite(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), note=None, **options
    ) -> int:
        start = batch_timestamp()
        rows = self.wh.overwrite(df, table, partition_by, **options)
        self.note(table, start, rows, note)
        return rows

    def append(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), note=None, **options
    ) -> int:
        start = batch_timestamp()
        rows = self.wh.append(df, table, partition_by, **options)
        self.note(table, start, rows, note)
        return rows

    def replace(self, df: DataFrame, table: str, key: str) -> int:
        """The whole table, with a part for each key value."""
        start = batch_timestamp()
        rows = self.wh.replace_where(df, table, key, whole=True)
        self.note(table, start, rows)
        return rows

    def close(self) -> dict[str, int]:
        log_events(self.wh, self.events, EVENTS)
        return self.rows


def atomic(step):
    """All tables that the step writes change together, its events included, or none."""

    @wraps(step)
    def run(wh: Warehouse, *args, **kwargs):
        with wh.transaction():
            return step(wh, *args, **kwargs)

    return run


def _together(jobs: Iterable[Callable[[], object]]) -> None:
    """Run writes that do not depend on each other at the same time, so that small tables
    do not leave the cluster idle."""
    with ThreadPoolExecutor(4) as pool:
        for running in [pool.submit(job) for job in jobs]:
            running.result()


def read_checks(wh: Warehouse) -> DataFrame:
    return wh.read(CHECKS, model.CHECK_SCHEMA)


def _log_checks(
    wh: Warehouse, checked: DataFrame, step: str = "", tables: Iterable[str] = ()
) -> None:
    """Append check results, keep the latest of each check, and note the versions of the
    tables that they are about."""
    seen = [(t, step, wh.version(t)) for t in sorted(set(tables))]
    with wh.transaction():
        upkeep.keep_checks(wh, checked)
        if seen:
            wh.append(wh.spark.createDataFrame(seen, CHECKED_TYPES).coalesce(1), CHECKED)


def _gate_versions(wh: Warehouse, tables: Iterable[str], step: str) -> None:
    """Each table was checked by the step as it is now (a row per table comes back)."""
    own = wh.read(CHECKED, StructType.fromDDL(CHECKED_TYPES)).filter(F.col("nombre_script") == step)
    seen = dict(own.groupBy("tabla").agg(F.max("version")).collect())
    stale = sorted(t for t in set(tables) if seen.get(t) != wh.version(t))
    if stale:
        raise RuntimeError(f"load refused: changed since {step}: {', '.join(stale)}")


def _stamped(df: DataFrame, ts: datetime, column: str = "fecha_carga") -> DataFrame:
    return df.withColumn(column, timestamp(ts))


# Acquisition ----------------------------------------------------------------
@atomic
def acquire(
    wh: Warehouse, folder: str, sources: Iterable[model.Source], step: str = "acquire",
    multi_line: bool = False,
) -> dict[str, int]:
    """Files to raw tables, all text. Files are split among tasks; in one whose records end in
    CR LF, fields may hold LF. Any other file with line breaks inside of fields raises, unless
    ``multi_line`` is set; it is then read by one task."""
    record = Recorder(wh, step, RAW_LOAD)

    def load(source: model.Source) -> None:
        ends = record_end(wh.spark, f"{folder}/{source.file}")
        rows = read_source(wh.spark, folder, source, multi_line, ends)
        record.overwrite(rows, source.raw_table)

    _together(partial(load, s) for s in sources)
    return record.close()


def check_raw(
    wh: Warehouse, sources: Iterable[model.Source], ts: datetime, step: str = "check_raw"
) -> None:
    sources = list(sources)
    tables = {s.raw_table: wh.read(s.raw_table) for s in sources}
    rules = [r for s in sources for r in ck.raw_rules(s)]
    _log_checks(wh, ck.run_checks(tables, rules, ts, step), step, tables)


@atomic
def profile_tables(
    wh: Warehouse, columns: Mapping[str, Sequence[str]], ts: datetime, step: str,
    table_row: bool = False, approx: bool = False,
) -> None:
    """Profiles of the given columns of each table, in one append. Approximate ones scan
    only the folders that were not profiled before."""
    if approx:
        rows = upkeep.refresh_profiles(wh, columns, ts, step, table_row)
    else:
        parts = [
            profile(wh.read(table), table, names, ts, step, table_row)
            for table, names in columns.items()
        ]
        rows = reduce(DataFrame.unionByName, parts)
    append_numbered(wh, rows, PROFILES, model.PROFILE_SCHEMA, ["tabla", "columna"])


def profile_raw(
    wh: Warehouse, sources: Iterable[model.Source], ts: datetime, step: str = "profile_raw",
    approx: bool = False,
) -> None:
    columns = {s.raw_table: s.columns for s in sources}
    profile_tables(wh, columns, ts, step, approx=approx)


@atomic
def stage(
    wh: Warehouse, sources: Iterable[model.Source], step: str = "stage",
    check_step: str = "check_raw",
) -> dict[str, int]:
    """Raw tables to typed ones, if their checks allow it and the targets are empty."""
    sources = list(sources)
    raw = [s.raw_table for s in sources]
    gates.gate_tables(upkeep.latest_checks(wh), raw, [check_step])
    _gate_versions(wh, raw, check_step)
    for source in sources:
        if wh.exists(source.staged_table):
            gates.gate_empty(wh.read(source.staged_table), source.staged_table)
    record = Recorder(wh, step, STAGED_LOAD)

    def load(source: model.Source) -> None:
        typed = to_typed(wh.read(source.raw_table), source.typed_columns)
        record.append(typed, source.staged_table)

    _together(partial(load, s) for s in sources)
    return record.close()


def check_keys(
    wh: Warehouse, keys: Iterable[model.ForeignKey], ts: datetime, step: str = "check_keys"
) -> None:
    rules = ck.foreign_key_rules(keys)
    names = {t for r in rules for t in (r.table, *r.parents)}
    tables = {t: wh.read(t) for t in names}
    _log_checks(wh, ck.run_checks(tables, rules, ts, step), step, names)


# Warehouse ------------------------------------------------------------------
def check_staged(
    wh: Warehouse, ts: datetime, step: str = "check_staged",
    earlier: Sequence[str] = ("check_raw", "check_keys"),
) -> None:
    """The 16 checks before the first load of the warehouse."""
    rules = ck.warehouse_rules()
    names = {t for r in rules for t in (r.table, *r.parents)}
    tables = {t: wh.read(t) for t in names}
    checked = ck.run_checks(tables, rules, ts, step)
    earlier_errors = ck.earlier_errors(upkeep.latest_checks(wh), earlier, ts, step)
    _log_checks(wh, checked.unionByName(earlier_errors), step, names)


def _dims(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "date": wh.read(DIM_DATE),
        "geography": wh.read(DIM_GEOGRAPHY),
        "customer": wh.read(DIM_CUSTOMER),
        "product": wh.read(DIM_PRODUCT),
        "employee": wh.read(DIM_EMPLOYEE),
        "shipper": wh.read(DIM_SHIPPER),
    }


def _fact_layout(fact: DataFrame) -> DataFrame:
    """Partition columns of the fact, a written table, and files of even size that each hold
    a range of orders of a month: a scan for some orders skips the others."""
    day = F.col("order_date_key")
    placed = fact.withColumns(
        {
            "order_year": F.floor(day / 10000).cast("int"),
            "order_month": F.floor(day / 100).cast("int") % 100,
        }
    )
    return by_order(placed, *FACT_PARTITIONS)


@atomic
def load_warehouse(
    wh: Warehouse, ts: datetime, step: str = "load_warehouse", check_step: str = "check_staged"
) -> dict[str, int]:
    """First load: six dimensions, the fact, two histories and two metric tables."""
    gates.gate_step(upkeep.latest_checks(wh), check_step, REQUIRED_CHECKS)
    _gate_versions(wh, {t for r in ck.warehouse_rules() for t in (r.table, *r.parents)}, check_step)
    targets = (
        DIM_DATE, DIM_GEOGRAPHY, DIM_CUSTOMER, DIM_PRODUCT, DIM_EMPLOYEE, DIM_SHIPPER, FACT,
        CUSTOMER_HISTORY, PRODUCT_HISTORY, CUSTOMER_METRICS, PRODUCT_METRICS,
    )
    for table in targets:
        if wh.exists(table):
            gates.gate_empty(wh.read(table), table)

    customers, employees, orders = (wh.read(f"tmp_{t}") for t in ("customers", "employees", "orders"))
    products, lines = wh.read("tmp_products"), wh.read("tmp_order_details")
    record = Recorder(wh, step, WAREHOUSE_LOAD)

    record.overwrite(star.build_dim_date(orders), DIM_DATE)
    places = star.build_dim_geography(star.source_geo(customers, employees, orders))
    keyed = assign_keys(places, ["geography_signature"], "geography_key")
    record.overwrite(_stamped(keyed, ts), DIM_GEOGRAPHY, key="geography_key")
    geography = wh.read(DIM_GEOGRAPHY)

    named = star.denormalise_products(
        products, wh.read("tmp_categories"), wh.read("tmp_suppliers")
    )
    dimensions = [
        (DIM_CUSTOMER, star.build_dim_customer(customers, geography), "customer"),
        (DIM_PRODUCT, named, "product"),
        (DIM_EMPLOYEE, star.build_dim_employee(employees, geography), "employee"),
        (DIM_SHIPPER, star.build_dim_shipper(wh.read("tmp_shippers")), "shipper"),
    ]

    def load_dimension(table: str, rows: DataFrame, name: str) -> None:
        keyed = assign_keys(rows, [f"{name}_id"], f"{name}_key")
        record.overwrite(_stamped(keyed, ts), table, key=f"{name}_key")

    _together(partial(load_dimension, *d) for d in dimensions)

    fact = wh.intermediate(assign_keys(
        star.build_fact(lines, orders, _dims(wh), "strict"), GRAIN, "order_line_key",
        bucket_digits=FACT_BUCKET_DIGITS, dense=False,
    ))
    upkeep.drop_sales_state(wh)
    record.overwrite(_fact_layout(_stamped(fact, ts)), FACT, FACT_PARTITIONS, key="order_line_key")

    histories = [
        (CUSTOMER_HISTORY, customers, "customer", model.CUSTOMER_ATTRIBUTES, ()),
        (PRODUCT_HISTORY, named, "product", model.PRODUCT_ATTRIBUTES, ("stock_alarm_level",)),
    ]

    def load_history(table: str, rows: DataFrame, name: str, attributes, extra) -> None:
        versions = scd2_init(rows, [f"{name}_id"], attributes, ts, extra)
        keyed = assign_keys(versions, [f"{name}_id"], f"{name}_history_key")
        record.overwrite(keyed, table, part=OPEN, key=f"{name}_history_key")

    _together(
        [*(partial(load_history, *h) for h in histories),
         lambda: _write_metrics(wh, record, ts)]
    )
    _log_checks(wh, ck.row_reconciliation(wh.read(FACT), lines, FACT, ts, step))
    return record.close()


def _write_metrics(wh: Warehouse, record: Recorder, ts: datetime) -> None:
    customers, products = upkeep.rebuild_metric_totals(wh, wh.read(FACT), wh.read(DIM_DATE))
    customer = metrics.customer_metrics(customers, wh.read(DIM_CUSTOMER))
    record.overwrite(_stamped(customer, ts, "fecha_calculo"), CUSTOMER_METRICS)
    product = metrics.product_metrics(products, wh.read(DIM_PRODUCT))
    record.overwrite(_stamped(product, ts, "fecha_calculo"), PRODUCT_METRICS)


@atomic
def refresh_metrics(
    wh: Warehouse, ts: datetime, step: str = "refresh_metrics", full: bool = False
) -> dict[str, int]:
    """Metrics of the customers and products that got lines since the last refresh, from
    their stored totals and partials: the fact is not read. Others keep their rows. ``full``
    works out all of them, and the state, from the fact."""
    record = Recorder(wh, step, WAREHOUSE_UPDATE)
    if full or not upkeep.has_metric_state(wh):
        _write_metrics(wh, record, ts)
        return record.close()
    for table, key, updated, build in (
        (CUSTOMER_METRICS, "customer_key", upkeep.refresh_customer_totals(wh, wh.read(DIM_DATE)),
         lambda rows: metrics.customer_metrics(rows, wh.read(DIM_CUSTOMER))),
        (PRODUCT_METRICS, "product_key", upkeep.refresh_product_totals(wh),
         lambda rows: metrics.product_metrics(rows, wh.read(DIM_PRODUCT))),
    ):
        if updated is not None:
            kept = wh.read(table).join(updated.select(key), key, "left_anti")
            record.overwrite(kept.unionByName(_stamped(build(updated), ts, "fecha_calculo")), table)
    return record.close()


@atomic
def check_fact(wh: Warehouse, ts: datetime, step: str = "check_fact") -> None:
    """Grain and foreign keys of the loaded fact. Only the loads that came since the last
    check are measured, and again those whose parents no longer vouch for them."""
    dimensions = {
        "customer": DIM_CUSTOMER, "product": DIM_PRODUCT, "employee": DIM_EMPLOYEE,
        "shipper": DIM_SHIPPER, "geography": DIM_GEOGRAPHY, "date": DIM_DATE,
    }
    rules = ck.fact_rules(FACT, dimensions)
    _log_checks(wh, upkeep.check_new_folders(wh, rules, ts, step), step, [FACT])


def profile_warehouse(
    wh: Warehouse, ts: datetime, step: str = "profile_warehouse", approx: bool = False
) -> None:
    tables = (
        DIM_DATE, DIM_GEOGRAPHY, DIM_CUSTOMER, DIM_PRODUCT, DIM_EMPLOYEE, DIM_SHIPPER, FACT,
        CUSTOMER_HISTORY, PRODUCT_HISTORY, CUSTOMER_METRICS, PRODUCT_METRICS,
    )
    columns = {t: [c for c in wh.read(t).columns if c not in FACT_PARTITIONS] for t in tables}
    profile_tables(wh, columns, ts, step, table_row=True, approx=approx)


# Delta ----------------------------------------------------------------------
def _apply_versions(
    wh: Warehouse, record: Recorder, ts: datetime, name: str, history_table: str,
    dim_table: str, incoming: DataFrame, attributes: Sequence[str], extra: Sequence[str],
    dim_rows: DataFrame, dim_columns: Sequence[str],
) -> int:
    """History and dimension of one entity: close and open versions, overwrite the rows of
    the incoming keys, and add rows for keys that are new. Closed versions are not read."""
    key = [f"{name}_id"]
    current, dim = wh.read(history_table, part=OPEN), wh.read(dim_table)
    # read by both parts of the history, the change log and the count
    opened = wh.intermediate(scd2_changes(current, incoming, key, attributes, ts, extra))
    number = f"{name}_history_key"
    numbered = assign_keys(opened, key, number, wh.highest(history_table))
    closed = scd2_closed(current, opened, key, ts)
    start = batch_timestamp()
    rows = wh.append(closed, history_table, part=CLOSED, key=number)
    rows += wh.overwrite(scd2_open(current, numbered, key), history_table, part=OPEN, key=number)
    record.note(history_table, start, rows)

    added = _stamped(
        assign_keys(insert_new(dim_rows, dim, key), key, f"{name}_key", wh.highest(dim_table)), ts
    )
    updated = scd1_update(dim, dim_rows.dropDuplicates(key), key, dim_columns)
    start = batch_timestamp()
    wh.overwrite(
        updated.unionByName(added, allowMissingColumns=True), dim_table, key=f"{name}_key"
    )
    changes = opened.select(
        timestamp(ts).alias("fecha"), F.lit(name).alias("entidad"),
        F.col(key[0]).cast("string").alias("clave"), F.lit("version").alias("cambio"),
    )
    count = wh.append(changes, CHANGES)
    record.note(dim_table, start, count, f"versions opened: {count}")
    return count


@atomic
def update_warehouse(
    wh: Warehouse, ts: datetime, step: str = "update_warehouse",
    check_step: str = "check_delta_keys",
) -> dict[str, float]:
    """Apply a staged delta: days, places, customers, products, then lines. The summary holds
    counts and the seconds it took; the keys are in the change log, by ``fecha``."""
    began = batch_timestamp()
    tables = sorted({f"tmp_{k.child}" for k in model.DELTA_KEYS})
    gates.gate_tables(upkeep.latest_checks(wh), tables, [check_step])
    _gate_versions(wh, tables, check_step)
    customers, products, orders, lines = (wh.read(s.staged_table) for s in model.DELTA)
    record = Recorder(wh, step, WAREHOUSE_UPDATE)
    summary: dict[str, float] = {}

    new_days = star.extend_dim_date(wh.read(DIM_DATE), orders)
    summary["fechas_nuevas"] = record.append(new_days.select(*wh.read(DIM_DATE).columns), DIM_DATE)

    places = assign_keys(
        star.extend_dim_geography(wh.read(DIM_GEOGRAPHY), orders, customers),
        ["geography_signature"], "geography_key", wh.highest(DIM_GEOGRAPHY),
    )
    summary["geografias_nuevas"] = record.append(
        _stamped(places, ts), DIM_GEOGRAPHY, key="geography_key"
    )
    geography = wh.read(DIM_GEOGRAPHY)

    summary["clientes_modificados"] = _apply_versions(
        wh, record, ts, "customer", CUSTOMER_HISTORY, DIM_CUSTOMER, customers,
        model.CUSTOMER_ATTRIBUTES, (),
        star.build_dim_customer(customers, geography),
        ("customer_geography_key", *model.CUSTOMER_ATTRIBUTES),
    )
    named = star.denormalise_products(
        products, wh.read("tmp_categories"), wh.read("tmp_suppliers")
    )
    summary["productos_modificados"] = _apply_versions(
        wh, record, ts, "product", PRODUCT_HISTORY, DIM_PRODUCT, named,
        model.PRODUCT_ATTRIBUTES, ("stock_alarm_level",), named,
        (*model.PRODUCT_ATTRIBUTES, "stock_alarm_level"),
    )

    # The size of written headers is known: with a small delta the lines do not move.
    dims, fact = _dims(wh), wh.read(FACT)
    headers = wh.intermediate(star.resolve_orders(orders, dims, "left"))
    built = star.build_fact(lines, orders, dims, "lenient", headers)
    # Of the fact, which is laid out by order, the row groups of the delta's orders are read.
    known = insert_new(built, fact, GRAIN, ranges={"order_id": key_ranges(headers, "order_id")})
    fresh = wh.intermediate(
        assign_keys(
            known, GRAIN, "order_line_key", wh.highest(FACT), bucket_digits=FACT_BUCKET_DIGITS, dense=False,
        )
    )
    dropped = star.dropped_lines(
        lines, orders, wh.read(DIM_CUSTOMER), wh.read(DIM_PRODUCT)
    ).count()
    summary["lineas_descartadas"] = dropped
    summary["lineas_hecho_nuevas"] = record.append(
        _fact_layout(_stamped(fresh, ts)), FACT, FACT_PARTITIONS,
        note=f"lines without order, customer or product: {dropped}", key="order_line_key",
    )
    upkeep.note_new_lines(wh, fresh, wh.read(DIM_DATE))
    record.close()
    summary["total_segundos"] = (batch_timestamp() - began).total_seconds()
    return summary


# Enrichment -----------------------------------------------------------------
@atomic
def integrate_countries(
    wh: Warehouse, folder: str, step: str = "integrate_countries", multi_line: bool = False
) -> dict[str, int]:
    record = Recorder(wh, step, ENRICHMENT)
    path = f"{folder}/{model.COUNTRY_FILE}"
    raw = read_country_attributes(wh.spark, path, multi_line, record_end(wh.spark, path))
    wh.overwrite(raw, RAW_COUNTRIES)
    enriched = enrichment.enrich_geography(wh.read(DIM_GEOGRAPHY), wh.read(RAW_COUNTRIES))
    record.overwrite(enriched, DIM_GEOGRAPHY, key="geography_key")
    return record.close()


@atomic
def integrate_scores(
    wh: Warehouse, folder: str, ts: datetime, step: str = "integrate_scores",
    multi_line: bool = False,
) -> dict[str, int]:
    record = Recorder(wh, step, ENRICHMENT)
    path = f"{folder}/{model.SCORE_FILE}"
    rows, rejected = read_scores(wh.spark, path, multi_line, record_end(wh.spark, path))
    wh.overwrite(rows, RAW_SCORES)
    refused = wh.overwrite(rejected, f"{RAW_SCORES}_rechazos")
    target = wh.read(SCORES) if wh.exists(SCORES) else wh.spark.createDataFrame([], SCORE_TYPES)
    best = enrichment.best_scores(wh.read(RAW_SCORES), wh.read(DIM_CUSTOMER))
    merged = enrichment.load_scores(target, best, ts)
    record.overwrite(merged, SCORES, note=f"records too short: {refused}")
    return record.close()


# Publication ----------------------------------------------------------------
@atomic
def publish(wh: Warehouse, ts: datetime, step: str = "publish") -> dict[str, int]:
    """The sales product and the three quality summaries. Sales are added up from their
    state per month, place and customer; of the fact only months with new lines are read."""
    record = Recorder(wh, step, PUBLICATION)
    if wh.exists(SCORES):
        scores = wh.read(SCORES)
    else:
        scores = wh.spark.createDataFrame([], SCORE_TYPES)
    state, divided = upkeep.refresh_sales_state(wh, wh.read(FACT), wh.read(DIM_DATE))
    sales = publication.dp01_from_state(
        state, divided, wh.read(DIM_GEOGRAPHY), wh.read(DIM_CUSTOMER), scores
    )
    profiles = wh.read(PROFILES, model.PROFILE_SCHEMA)
    products = [
        (sales, SALES),
        (publication.dp02_events(wh.read(EVENTS, model.EVENT_SCHEMA)), EVENT_SUMMARY),
        (publication.dp02_profiles_or_default(profiles, timestamp(ts)), PROFILE_SUMMARY),
    ]
    summary = _stamped(publication.dp02_checks(read_checks(wh)), ts, "fecha_publicacion")
    _together([
        *(partial(record.overwrite, _stamped(df, ts, "fecha_publicacion"), table) for df, table in products),
        lambda: record.replace(summary, CHECK_SUMMARY, "nombre_script"),
    ])
    return record.close()


@atomic
def check_published(wh: Warehouse, ts: datetime, step: str = "check_published") -> None:
    """Six checks on the products; their own rows in the summary are replaced."""

    def refresh_summary() -> None:
        own = publication.dp02_step_checks(read_checks(wh), step)
        wh.replace_where(
            _stamped(own, ts, "fecha_publicacion"), CHECK_SUMMARY, "nombre_script"
        )

    sales = ck.run_checks({SALES: wh.read(SALES)}, ck.sales_rules(SALES), ts, step)
    log = ck.log_without_errors(upkeep.latest_checks(wh), ts, step, CHECKS)
    _log_checks(wh, sales.unionByName(log))
    refresh_summary()
    tables = {t: wh.read(t) for t in (CHECK_SUMMARY, EVENT_SUMMARY, PROFILE_SUMMARY)}
    _log_checks(wh, ck.tables_not_empty(tables, "dp02_dqm_*", ts, step))
    refresh_summary()


def dashboards(wh: Warehouse, step: str = "dashboards") -> dict[str, DataFrame]:
    """The report queries over the published products."""
    sales, checks = wh.read(SALES), wh.read(CHECK_SUMMARY)
    top = dashboard.top_countries(sales)
    reports = {
        "kpis": dashboard.kpis(sales),
        "top_countries": dashboard.bar_width(top, "venta_neta"),
        "segments": dashboard.segments(sales),
        "monthly": dashboard.monthly(sales),
        "check_status": dashboard.check_status(checks),
        "event_status": dashboard.event_status(wh.read(EVENT_SUMMARY)),
        "top_profiles": dashboard.top_profiles(wh.read(PROFILE_SUMMARY)),
        "recent_checks": dashboard.recent_checks(checks),
    }
    record = Recorder(wh, step, DASHBOARD)
    record.note(DASHBOARDS, batch_timestamp(), len(reports))
    record.close()
    return reports


# Whole loads ----------------------------------------------------------------
def initial_load(
    wh: Warehouse, folder: str, ts: datetime | None = None, approx_profiles: bool = False,
    multi_line: bool = False,
) -> dict[str, int]:
    """Initial files to a loaded warehouse. Files with line breaks inside of fields need
    ``multi_line=True``; large tables should be profiled with ``approx_profiles=True``."""
    ts = ts or batch_timestamp()
    acquire(wh, folder, model.INITIAL, multi_line=multi_line)
    check_raw(wh, model.INITIAL, ts)
    profile_raw(wh, model.INITIAL, ts, approx=approx_profiles)
    stage(wh, model.INITIAL)
    check_keys(wh, model.INITIAL_KEYS, ts)
    check_staged(wh, ts)
    rows = load_warehouse(wh, ts)
    profile_warehouse(wh, ts, approx=approx_profiles)
    return rows


def delta_load(
    wh: Warehouse, folder: str, ts: datetime | None = None, approx_profiles: bool = False,
    multi_line: bool = False,
) -> dict[str, float]:
    """Delta files into the warehouse."""
    ts = ts or batch_timestamp()
    acquire(wh, folder, model.DELTA, "acquire_delta", multi_line)
    check_raw(wh, model.DELTA, ts, "check_delta")
    profile_raw(wh, model.DELTA, ts, "profile_delta", approx_profiles)
    with wh.transaction():  # a new delta replaces the staged rows of the one before
        for source in model.DELTA:
            wh.drop(source.staged_table)
    stage(wh, model.DELTA, "stage_delta", "check_delta")
    check_keys(wh, model.DELTA_KEYS, ts, "check_delta_keys")
    summary = update_warehouse(wh, ts)
    refresh_metrics(wh, ts)
    return summary
