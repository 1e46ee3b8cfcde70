"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silostar.functions import columns as fx
from silostar.functions import display
from silostar.operators import checks as ck
from silostar.operators import gates, history, increments, keys, merge, pruning, ranking
from silostar.operators.profile import merged_profile, partial_profile, profile
from silostar.plans import dashboard, enrichment, metrics, publication, staging, star
from silostar.workload.inputs import (
    BATCH_TS,
    DELTA_FROM,
    LOAD_TS,
    Inputs,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUSTOMER_ATTRIBUTES = star.CUSTOMER_ATTRIBUTES
STEP = "check"


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: published(build(Inputs(spark, folder)))
    return build


def published(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, so that both engines compare the same type."""
    decimals = {n for n, t in df.dtypes if t.startswith("decimal")}
    return df.select(*[F.col(c).cast("double") if c in decimals else F.col(c) for c in df.columns])


def _checked(i: Inputs, tables: dict[str, DataFrame], *rules: ck.Rule) -> DataFrame:
    return ck.run_checks(tables, rules, BATCH_TS, STEP)


# Raw text -------------------------------------------------------------------
def _raw_orders(i: Inputs, dirty: bool) -> DataFrame:
    """Orders as text: the literal NULL for unshipped ones and, if dirty, bad formats."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS")
    if dirty:
        partial = status == "P"
        key = (
            F.when(partial & (priority == "5-LOW"), F.concat(F.lit("-"), key))
            .when(partial & (priority == "2-HIGH"), F.concat(key, F.lit("\n")))
            .when(partial & (priority == "1-URGENT"), F.lit(""))
            .when(partial & (priority == "3-MEDIUM"), F.lit(None))
            .otherwise(key)
        )
        price = (
            F.when(partial & (priority == "5-LOW"), F.concat(F.lit("-"), price))
            .when(partial & (priority == "2-HIGH"), F.concat(F.substring_index(price, ".", 1), F.lit(".")))
            .when(partial & (priority == "1-URGENT"), F.lit("N/A"))
            .otherwise(price)
        )
        day = (
            F.when(partial & (priority == "5-LOW"), F.substring(day, 1, 19))
            .when(partial & (priority == "2-HIGH"), F.concat(day, F.lit("\n")))
            .when(partial & (priority == "3-MEDIUM"), F.lit(None))
            .otherwise(day)
        )
    return i.table("orders").select(
        key.alias("order_id"),
        F.when(status == "O", "NULL").otherwise(day).alias("order_date"),
        price.alias("freight"),
        priority.alias("ship_city"),
        F.lit("0x00").alias("picture"),
    )


@query
def raw_to_typed(i: Inputs) -> DataFrame:
    raw = _raw_orders(i, dirty=False)
    text = raw.select(*[F.nullif(F.col(c), F.lit("NULL")).alias(c) for c in raw.columns])
    types = {
        "order_id": "bigint", "order_date": "timestamp_ntz", "freight": "decimal(12,4)",
        "ship_city": "string",
    }
    return staging.to_typed(text, types)


# Format and key checks ------------------------------------------------------
@query
def check_format_integer(i: Inputs) -> DataFrame:
    rule = ck.Rule(ck.INTEGER_FORMAT, "txt_orders", ("order_id",))
    return _checked(i, {"txt_orders": _raw_orders(i, True)}, rule)


@query
def check_format_numeric(i: Inputs) -> DataFrame:
    rule = ck.Rule(ck.NUMERIC_FORMAT, "txt_orders", ("freight",))
    return _checked(i, {"txt_orders": _raw_orders(i, True)}, rule)


@query
def check_format_timestamp(i: Inputs) -> DataFrame:
    raw = _raw_orders(i, True)
    text = raw.withColumn("order_date", F.nullif(F.col("order_date"), F.lit("NULL")))
    rule = ck.Rule(ck.TIMESTAMP_FORMAT, "txt_orders", ("order_date",))
    return _checked(i, {"txt_orders": text}, rule)


def _holed_lines(i: Inputs) -> DataFrame:
    """Line keys with holes: no order where returned and open, no number where not."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return i.table("lineitem").select(
        F.when((flag != "R") | (status != "O"), F.col("l_orderkey")).alias("order_id"),
        F.when((flag != "A") | (status != "F"), F.col("l_linenumber")).alias("line_number"),
    )


@query
def check_not_null(i: Inputs) -> DataFrame:
    names = i.customers.withColumn("company_name", F.nullif(F.trim("city"), F.lit("")))
    rules = [ck.Rule(ck.NOT_NULL, "txt_customers", (c,)) for c in ("company_name", "fax")]
    return _checked(i, {"txt_customers": names}, *rules)


@query
def check_pk_nulls(i: Inputs) -> DataFrame:
    rules = [ck.Rule(ck.KEY_NULLS, "txt_order_details", (c,)) for c in ("order_id", "line_number")]
    return _checked(i, {"txt_order_details": _holed_lines(i)}, *rules)


@query
def check_pk_duplicates_simple(i: Inputs) -> DataFrame:
    tables = {"txt_order_details": _holed_lines(i), "txt_customers": i.customers}
    return _checked(
        i, tables,
        ck.Rule(ck.KEY_DUPLICATES, "txt_order_details", ("order_id",)),
        ck.Rule(ck.KEY_DUPLICATES, "txt_customers", ("customer_id",)),
    )


@query
def check_pk_duplicates_composite(i: Inputs) -> DataFrame:
    rule = ck.Rule(ck.KEY_DUPLICATES, "txt_order_details", ("order_id", "line_number"))
    return _checked(i, {"txt_order_details": _holed_lines(i)}, rule)


@query
def check_foreign_keys(i: Inputs) -> DataFrame:
    """Returned and open lines point to products that do not exist, lines not returned to
    none; the order key is text on one side and a number on the other."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    astray = F.col("l_partkey") + 1_000_000_000_000
    lines = i.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(flag == "N", None).when((flag == "R") & (status == "O"), astray)
        .otherwise(F.col("l_partkey")).alias("product_id"),
    )
    tables = {
        "tmp_order_details": lines,
        "tmp_orders": i.table("orders").select(F.col("o_orderkey").alias("order_id")),
        "tmp_products": i.products,
    }
    return _checked(
        i, tables,
        ck.Rule(ck.FOREIGN_KEY, "tmp_order_details", ("order_id",), ("tmp_orders",), "order_id"),
        ck.Rule(ck.FOREIGN_KEY, "tmp_order_details", ("product_id",), ("tmp_products",), "product_id"),
        ck.Rule(ck.DIMENSION_JOIN, "tmp_order_details", ("product_id",), ("tmp_products",), "product_id"),
    )


@query
def check_self_reference(i: Inputs) -> DataFrame:
    """Customers refer to another customer through a number made of nation and key."""
    referred = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey") * 2 - F.col("c_nationkey"))
    people = i.table("customer").select(
        F.col("c_custkey").alias("employee_id"), referred.alias("reports_to")
    )
    rule = ck.Rule(
        ck.FOREIGN_KEY, "tmp_employees", ("reports_to",), ("tmp_employees",), "employee_id"
    )
    return _checked(i, {"tmp_employees": people}, rule)


@query
def check_fact_grain(i: Inputs) -> DataFrame:
    rule = ck.Rule(ck.FACT_GRAIN, "tmp_order_details", ("order_id", "product_id"))
    return _checked(i, {"tmp_order_details": i.order_details}, rule)


@query
def check_fact_grain_of_load(i: Inputs) -> DataFrame:
    """The same check, of the lines before the delta as a whole and of the delta as a load:
    its keys are counted, and looked up in the table within their ranges."""
    rule = ck.Rule(ck.FACT_GRAIN, "tmp_order_details", ("order_id", "product_id"))
    # The order keys of a task are hashed and its lines pass by, where a merge join sorts both.
    known = i.before_delta(i.order_headers).select("order_id").hint("shuffle_hash")
    earlier = i.order_details.join(known, "order_id", "left_semi")
    load = i.order_details.join(known, "order_id", "left_anti")
    rows = i.order_details.count()  # from the footers
    parts = ck.measure_duplicates(earlier, rule, rows).unionByName(
        increments.duplicates_of_load(load, earlier, rule, rows)
    )
    return ck.results_of(parts, rule, BATCH_TS, STEP)


@query
def check_measures(i: Inputs) -> DataFrame:
    rule = ck.Rule(ck.VALID_MEASURE, "tmp_order_details", ("unit_price", "quantity", "discount"))
    return _checked(i, {"tmp_order_details": i.order_details}, rule)


@query
def check_stock(i: Inputs) -> DataFrame:
    columns = ("units_in_stock", "units_on_order", "reorder_level")
    return _checked(i, {"tmp_products": i.products}, ck.Rule(ck.VALID_STOCK, "tmp_products", columns))


@query
def check_required_text(i: Inputs) -> DataFrame:
    tables = {"tmp_customers": i.customers, "tmp_orders": i.orders}
    return _checked(
        i, tables,
        ck.Rule(ck.REQUIRED_PLACE, "tmp_customers", ("city",)),
        ck.Rule(ck.REQUIRED_PLACE, "tmp_customers", ("country",)),
        ck.Rule(ck.REQUIRED_PLACE, "tmp_orders", ("ship_region",)),
    )


@query
def check_required_date(i: Inputs) -> DataFrame:
    rules = [ck.Rule(ck.REQUIRED_DATE, "tmp_orders", (c,)) for c in star.ORDER_DATES]
    return _checked(i, {"tmp_orders": i.order_headers}, *rules)


@query
def check_non_empty(i: Inputs) -> DataFrame:
    none = i.table("part").filter("p_size < 0")
    tables = {
        "tmp_orders": i.table("orders"), "tmp_order_details": i.table("lineitem"),
        "tmp_products": none,
    }
    return _checked(
        i, tables, *[ck.Rule(ck.SOURCE_NOT_EMPTY, t) for t in tables]
    ).unionByName(ck.tables_not_empty(tables, "dp02_dqm_*", BATCH_TS, STEP))


@query
def check_row_reconciliation(i: Inputs) -> DataFrame:
    """The fact holds each order and product once, the source holds duplicates."""
    lines = i.table("lineitem")
    fact = lines.select("l_orderkey", "l_partkey").distinct()
    return ck.row_reconciliation(fact, lines, "dwa_fact_order_lines", BATCH_TS, STEP)


@query
def check_previous_errors(i: Inputs) -> DataFrame:
    log = i.check_log
    return (
        ck.earlier_errors(log, ["check_raw"], BATCH_TS, STEP)
        .unionByName(ck.earlier_errors(log, ["check_unknown"], BATCH_TS, STEP, "none"))
        .unionByName(ck.log_without_errors(log, BATCH_TS, "check_raw"))
    )


@query
def check_published(i: Inputs) -> DataFrame:
    table = "dp01_ventas_geo_score"
    return ck.run_checks({table: _dp01(i)}, ck.sales_rules(table), BATCH_TS, STEP)


@query
def errors_by_table(i: Inputs) -> DataFrame:
    return ck.errors_by_table(i.check_log)


@query
def latest_check_status(i: Inputs) -> DataFrame:
    return gates.latest_status(i.check_log)


@query
def latest_checks(i: Inputs) -> DataFrame:
    return ranking.latest(i.check_log).select("id", "tabla", "columna", "tipo_chequeo", "resultado")


# Profiles -------------------------------------------------------------------
CUSTOMER_PROFILE = (
    "customer_id", "company_name", "contact_title", "city", "region", "country", "fax",
)
ORDER_PROFILE = ("order_id", "customer_id", "order_date", "shipped_date", "ship_city")


def _profiles(i: Inputs) -> DataFrame:
    customers = profile(
        i.customers, "tmp_customers", CUSTOMER_PROFILE, BATCH_TS, "profile", table_row=True
    )
    headers = i.order_headers.withColumns(
        {c: F.to_date(c) for c in ("order_date", "shipped_date")}
    )
    orders = profile(headers, "tmp_orders", ORDER_PROFILE, BATCH_TS, "profile", table_row=True)
    places = profile(i.orders, "tmp_orders", ("ship_country",), BATCH_TS, "profile")
    return customers.unionByName(orders).unionByName(places)


@query
def profile_columns(i: Inputs) -> DataFrame:
    return _profiles(i)


MERGED_PROFILE = ("order_id", "ship_city", "ship_postal_code", "employee_id", "ship_via", "ship_country")


@query
def profile_merged(i: Inputs) -> DataFrame:
    """The profile of the orders from those of their parts before and with the delta. The
    distinct orders are an estimate: shown is whether it is within a twentieth of the exact
    number. Few distinct values are exact."""
    names = list(MERGED_PROFILE)
    parts = [partial_profile(part(i.orders), names) for part in (i.before_delta, i.in_delta)]
    merged = merged_profile(
        parts[0].unionByName(parts[1]), i.orders, "tmp_orders", names, BATCH_TS, "profile", table_row=True
    )
    exact = i.order_headers.select(F.count_distinct("order_id")).scalar()
    found, estimated = F.col("valores_distintos"), F.col("columna") == "order_id"
    return merged.withColumns({
        "valores_distintos": F.when(estimated, F.lit(None)).otherwise(found),
        "cercano": F.when(estimated, F.abs(found - exact) <= 0.05 * exact),
    })


# Dimensions -----------------------------------------------------------------
@query
def dim_date(i: Inputs) -> DataFrame:
    return star.build_dim_date(i.order_headers)


@query
def dim_date_extend(i: Inputs) -> DataFrame:
    known = star.build_dim_date(i.before_delta(i.order_headers))
    return star.extend_dim_date(known, i.in_delta(i.order_headers))


def _geography(i: Inputs, orders: DataFrame) -> DataFrame:
    return star.build_dim_geography(star.source_geo(i.customers, i.employees, orders))


@query
def dim_geography(i: Inputs) -> DataFrame:
    return _geography(i, i.orders)


@query
def dim_geography_extend(i: Inputs) -> DataFrame:
    return star.extend_dim_geography(
        _geography(i, i.early_orders), i.delta_orders
    )


@query
def dim_customer(i: Inputs) -> DataFrame:
    return star.build_dim_customer(i.customers, i.dim_geography)


@query
def dim_customer_extend(i: Inputs) -> DataFrame:
    """The customers that a delta adds to the dimension, in their places."""
    known = i.base_customers.select("customer_id")
    return merge.insert_new(
        star.build_dim_customer(i.delta_customers, i.dim_geography), known, ["customer_id"]
    )


@query
def dim_employee(i: Inputs) -> DataFrame:
    return star.build_dim_employee(i.employees, i.dim_geography)


@query
def dim_shipper(i: Inputs) -> DataFrame:
    return star.build_dim_shipper(i.shippers)


@query
def dim_product(i: Inputs) -> DataFrame:
    return star.denormalise_products(i.products, i.categories, i.suppliers)


@query
def surrogate_keys(i: Inputs) -> DataFrame:
    """Keys for the customers already known, then for the new ones after the highest."""
    people = i.table("customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    before = people.filter("c_mktsegment <> 'FURNITURE'").select("customer_id")
    known = keys.assign_keys(before, ["customer_id"], "customer_key")
    fresh = merge.not_present(people.select("customer_id"), before, ["customer_id"])
    return known.unionByName(
        keys.assign_keys(fresh, ["customer_id"], "customer_key", existing=known)
    )


# Fact -----------------------------------------------------------------------
@query
def line_amounts(i: Inputs) -> DataFrame:
    """Price times quantity at list price, under both rules for a missing discount."""
    prices = i.products.select("product_id", F.col("unit_price").alias("list_price"))
    lines = i.order_details.join(prices, "product_id")
    gross = F.col("list_price") * F.col("quantity")
    strict = fx.line_amounts(gross, "discount", null_discount=0)
    lenient = fx.line_amounts(gross, "discount")
    return lines.select(
        "order_id", "product_id", "line_number", *strict,
        lenient[1].alias("delta_discount_amount"), lenient[2].alias("delta_net_amount"),
    )


@query
def fact_lines(i: Inputs) -> DataFrame:
    return star.build_fact(i.order_details, i.orders, i.dims, "strict")


def _delta_dims(i: Inputs) -> dict[str, DataFrame]:
    """Dimensions at the time of a delta that brings unknown shippers, places and days."""
    return i.dims | {
        "date": star.build_dim_date(i.before_delta(i.order_headers)),
        "geography": i.geography(i.base_orders),
        "shipper": i.dims["shipper"].filter("shipper_id < 3"),
    }


@query
def fact_lines_delta(i: Inputs) -> DataFrame:
    return star.build_fact(i.order_details, i.delta_orders, _delta_dims(i), "lenient")


@query
def dropped_lines(i: Inputs) -> DataFrame:
    """Lines that a delta cannot load while its new customers and products are unknown."""
    return star.dropped_lines(
        i.order_details, i.delta_orders, i.base_customers, i.base_products
    ).select("order_id", "product_id", "line_number", "quantity")


@query
def fact_insert_ignore(i: Inputs) -> DataFrame:
    """Lines of all orders into a fact that holds those before the delta: known keys are
    ignored, and of several new lines with one key the lowest line number comes in."""
    old = i.before_delta(i.order_headers).select("order_id")
    existing = i.order_details.join(old, "order_id", "left_semi")
    grain = ["order_id", "product_id"]
    order = [F.col(c) for c in ("line_number", "gross_amount", "quantity", "discount")]
    return merge.insert_new(i.order_details, existing, grain, order)


@query
def fact_insert_ranges(i: Inputs) -> DataFrame:
    """The same insert for the lines of the delta's orders, into a target that is read only
    within the ranges of these orders."""
    old = i.before_delta(i.order_headers).select("order_id")
    existing = i.order_details.filter("line_number < 3").join(old, "order_id", "left_semi")
    fresh = i.order_details.filter("line_number >= 3")
    order = [F.col(c) for c in ("line_number", "gross_amount", "quantity", "discount")]
    ranges = {"order_id": pruning.key_ranges(fresh, "order_id")}
    return merge.insert_new(fresh, existing, ["order_id", "product_id"], order, ranges)


@query
def order_freight(i: Inputs) -> DataFrame:
    lines = i.order_details.select("order_id").join(
        i.order_headers.select("order_id", F.col("freight").alias("order_freight_amount")),
        "order_id",
    )
    return star.order_freight(lines)


# History --------------------------------------------------------------------
def _history(i: Inputs) -> DataFrame:
    return history.scd2_init(i.base_customers, ["customer_id"], CUSTOMER_ATTRIBUTES, LOAD_TS)


@query
def scd2_init(i: Inputs) -> DataFrame:
    return _history(i)


@query
def scd2_apply(i: Inputs) -> DataFrame:
    return history.scd2_apply(
        _history(i), i.delta_customers, ["customer_id"], CUSTOMER_ATTRIBUTES, BATCH_TS
    )


@query
def scd1_update(i: Inputs) -> DataFrame:
    changed = history.scd2_changes(
        _history(i), i.delta_customers, ["customer_id"], CUSTOMER_ATTRIBUTES, BATCH_TS
    )
    dim = i.base_customers.select("customer_id", *CUSTOMER_ATTRIBUTES)
    return merge.scd1_update(dim, changed, ["customer_id"], CUSTOMER_ATTRIBUTES)


@query
def scd2_product_init(i: Inputs) -> DataFrame:
    from silostar.model import PRODUCT_ATTRIBUTES

    named = star.denormalise_products(i.products, i.categories, i.suppliers)
    return history.scd2_init(
        named, ["product_id"], PRODUCT_ATTRIBUTES, LOAD_TS, extra=["stock_alarm_level"]
    )


def _named(i: Inputs, products: DataFrame) -> DataFrame:
    return star.denormalise_products(products, i.categories, i.suppliers)


@query
def scd2_product_apply(i: Inputs) -> DataFrame:
    from silostar.model import PRODUCT_ATTRIBUTES

    key, extra = ["product_id"], ["stock_alarm_level"]
    old = history.scd2_init(_named(i, i.base_products), key, PRODUCT_ATTRIBUTES, LOAD_TS, extra)
    incoming = _named(i, i.delta_products)
    return history.scd2_apply(old, incoming, key, PRODUCT_ATTRIBUTES, BATCH_TS, extra)


@query
def scd1_product_update(i: Inputs) -> DataFrame:
    from silostar.model import PRODUCT_ATTRIBUTES

    columns = (*PRODUCT_ATTRIBUTES, "stock_alarm_level")
    dim, incoming = (_named(i, p) for p in (i.base_products, i.delta_products))
    return merge.scd1_update(dim, incoming, ["product_id"], columns)


# Metrics --------------------------------------------------------------------
@query
def customer_sales_metrics(i: Inputs) -> DataFrame:
    return metrics.customer_sales_metrics(i.sales, i.dim_customer, i.order_days)


@query
def product_sales_metrics(i: Inputs) -> DataFrame:
    return metrics.product_sales_metrics(i.sales, i.dim_product, i.order_days)


def _loads(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """The lines as a first load and a delta that adds lines to known orders."""
    late = F.col("quantity") % 3 == 0
    return i.sales.filter(~late), i.sales.filter(late)


@query
def customer_metrics_after_delta(i: Inputs) -> DataFrame:
    """The same metrics from the totals of a first load and the partials of a delta."""
    first, delta = _loads(i)
    known, touched = metrics.customer_orders(first), metrics.customer_orders(delta)
    before = known.join(touched.select(*metrics.CUSTOMER_ORDER), list(metrics.CUSTOMER_ORDER), "left_semi")
    totals = metrics.customer_totals(known, i.order_days)
    updated, _ = metrics.updated_customer_totals(totals, touched, before, i.order_days)
    others = totals.join(touched.select("customer_key").distinct(), "customer_key", "left_anti")
    return metrics.customer_metrics(others.unionByName(updated), i.dim_customer)


@query
def product_metrics_after_delta(i: Inputs) -> DataFrame:
    first, delta = _loads(i)
    known, touched = (metrics.product_orders(part, i.order_days) for part in (first, delta))
    totals = metrics.product_totals(known)
    updated = metrics.updated_product_totals(totals, touched, known)
    others = totals.join(touched.select("product_key").distinct(), "product_key", "left_anti")
    return metrics.product_metrics(others.unionByName(updated), i.dim_product)


# Enrichment -----------------------------------------------------------------
@query
def enrich_geography(i: Inputs) -> DataFrame:
    return i.enriched_geography


@query
def score_best_per_customer(i: Inputs) -> DataFrame:
    return enrichment.best_scores(i.raw_scores, i.dim_customer)


@query
def score_upsert(i: Inputs) -> DataFrame:
    """Scores of the file into a table that holds those of account balances over 5000."""
    target = i.customer_scores.join(
        i.table("customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("customer_id")),
        "customer_id", "left_semi",
    ).select("customer_key", "customer_id", "score", "fecha_carga")
    best = enrichment.best_scores(i.raw_scores, i.dim_customer)
    return enrichment.load_scores(target, best, BATCH_TS)


# Publication ----------------------------------------------------------------
def _dp01(i: Inputs) -> DataFrame:
    return publication.dp01_sales_geo_score(
        i.placed_sales, i.order_days, i.enriched_geography, i.dim_customer, i.customer_scores
    )


@query
def dp01_sales_geo_score(i: Inputs) -> DataFrame:
    return _dp01(i)


@query
def dp01_from_state(i: Inputs) -> DataFrame:
    """The same product from the state of the months before the delta and of its months."""
    fact, first = i.placed_sales, F.col("order_date_key") < int(DELTA_FROM.replace("-", ""))
    parts = [fact.filter(first), fact.filter(~first)]
    state, divided = (
        build(parts[0], i.order_days).unionByName(build(parts[1], i.order_days))
        for build in (publication.sales_state, publication.divided_orders)
    )
    return publication.dp01_from_state(state, divided, i.enriched_geography, i.dim_customer, i.customer_scores)


@query
def dp02_checks(i: Inputs) -> DataFrame:
    return publication.dp02_checks(i.check_log)


@query
def dp02_step_checks(i: Inputs) -> DataFrame:
    return publication.dp02_step_checks(i.check_log, "check_raw")


@query
def dp02_events(i: Inputs) -> DataFrame:
    return publication.dp02_events(i.event_log)


@query
def dp02_profiles(i: Inputs) -> DataFrame:
    return publication.dp02_profiles(_profiles(i))


@query
def dp02_profiles_default(i: Inputs) -> DataFrame:
    """The summary of the columns with nulls, and that of the columns with nothing else that
    are not all null, each with the row that stands in where there is none."""
    now, profiles = history.timestamp(BATCH_TS), _profiles(i)
    cases = {"con_nulos": "nulos > 0", "sin_valores": "nulos > 0 AND valores_distintos = 0 AND nulos < total_filas"}
    parts = [
        publication.dp02_profiles_or_default(profiles.filter(test), now).withColumn("caso", F.lit(name))
        for name, test in cases.items()
    ]
    return parts[0].unionByName(parts[1])


# Dashboards -----------------------------------------------------------------
@query
def dash_kpis(i: Inputs) -> DataFrame:
    return dashboard.kpis(_dp01(i))


@query
def dash_top_countries(i: Inputs) -> DataFrame:
    return dashboard.top_countries(_dp01(i))


@query
def dash_segments(i: Inputs) -> DataFrame:
    return dashboard.segments(_dp01(i))


@query
def dash_monthly(i: Inputs) -> DataFrame:
    return dashboard.monthly(_dp01(i))


@query
def dash_bars(i: Inputs) -> DataFrame:
    shown = dashboard.top_countries(_dp01(i)).select("ship_country", "venta_neta")
    return dashboard.bar_width(shown, "venta_neta")


@query
def dash_check_status(i: Inputs) -> DataFrame:
    return dashboard.check_status(publication.dp02_checks(i.check_log))


@query
def dash_event_status(i: Inputs) -> DataFrame:
    return dashboard.event_status(publication.dp02_events(i.event_log))


@query
def dash_top_profiles(i: Inputs) -> DataFrame:
    return dashboard.top_profiles(publication.dp02_profiles(_profiles(i)))


@query
def dash_recent_checks(i: Inputs) -> DataFrame:
    return dashboard.recent_checks(publication.dp02_checks(i.check_log))


@query
def dash_display(i: Inputs) -> DataFrame:
    """Order amounts and event times as reports show them."""
    return i.order_headers.select(
        "order_id",
        display.display_currency(F.col("freight")).alias("freight"),
        display.display_number(F.col("freight")).alias("amount"),
        display.display_time(F.col("shipped_date")).alias("shipped"),
    )
