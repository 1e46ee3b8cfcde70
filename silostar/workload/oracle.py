"""The registered queries as SQL over the given tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

BATCH = "TIMESTAMP '2024-06-30 12:00:00'"
LOAD = "TIMESTAMP '2024-01-01 00:00:00'"
DELTA = "TIMESTAMP '2001-01-01 00:00:00'"

# Staged tables --------------------------------------------------------------
CTES = {
    "places": """
        SELECT n_nationkey, n_name, n_regionkey, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS company_name,
               CAST(NULL AS VARCHAR) AS contact_name, c_mktsegment AS contact_title,
               CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_mktsegment END AS city,
               r_name AS region, CAST(NULL AS VARCHAR) AS postal_code,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' || n_name || '  '
                    ELSE n_name END AS country,
               CAST(c_nationkey AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS fax
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "employees": """
        SELECT n_nationkey AS employee_id, n_name AS first_name, r_name AS last_name,
               'Sales' AS title, CAST(NULL AS VARCHAR) AS city, r_name AS region,
               n_name AS country, n_regionkey AS reports_to
        FROM places""",
    "categories": """
        SELECT DISTINCT p_type AS category_id, lower(p_type) AS category_name
        FROM part WHERE p_type <> 'PROMO'""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_id,
               CAST(p_size AS BIGINT) AS supplier_id, p_brand AS quantity_per_unit,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
               CASE WHEN p_brand <> 'Brand#1' THEN p_size - 10 END AS units_in_stock,
               CASE WHEN p_brand <> 'Brand#2' THEN p_size END AS units_on_order,
               CASE WHEN p_type <> 'SMALL' THEN 15 END AS reorder_level,
               CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS discontinued
        FROM part""",
    "base_products": "SELECT * FROM products WHERE quantity_per_unit <> 'Brand#3'",
    "delta_products": """
        SELECT * REPLACE (
            CASE WHEN category_id = 'ECONOMY' THEN product_name || ' (new)'
                 ELSE product_name END AS product_name,
            coalesce(reorder_level, 12) AS reorder_level)
        FROM products""",
    "headers": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_nationkey AS employee_id,
               o_orderdate AS order_date, o_orderdate + INTERVAL 30 DAY AS required_date,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 7 DAY END
                 AS shipped_date,
               n_regionkey AS ship_via, CAST(o_totalprice AS DECIMAL(12,2)) AS freight,
               n_name AS ship_country,
               CASE WHEN o_orderpriority <> '5-LOW' THEN r_name END AS ship_region,
               o_orderpriority AS ship_city, o_orderstatus AS ship_postal_code
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN places ON c_nationkey = n_nationkey""",
    "details": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
               CAST(l_quantity AS INTEGER) AS quantity,
               CASE WHEN l_returnflag <> 'N' THEN CAST(l_discount AS DECIMAL(4,2)) END
                 AS discount,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount
        FROM lineitem""",
    "base_headers": f"SELECT * FROM headers WHERE order_date < {DELTA}",
    "delta_headers": f"SELECT * FROM headers WHERE order_date >= {DELTA}",
    "base_customers": "SELECT * FROM customers WHERE contact_title <> 'FURNITURE'",
    "delta_customers": """
        SELECT * REPLACE (
            CASE WHEN trim(city) = '' THEN 'ALTERED' ELSE contact_title END AS contact_title,
            CASE WHEN region = 'AFRICA' THEN phone ELSE fax END AS fax)
        FROM customers""",
    "sales": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
               c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                 AS discounted,
               CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                 AS net
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "countries": """
        SELECT CASE n_name WHEN 'NATION_1' THEN 'First Nation'
                           WHEN 'NATION_2' THEN 'Second Nation' ELSE n_name END AS country,
               CASE WHEN n_nationkey IN (2, 6) THEN ' '
                    ELSE 'N' || CAST(n_nationkey AS VARCHAR) END AS iso_code,
               'Capital of ' || n_name AS capital,
               CASE WHEN r_name = 'ASIA' THEN '' ELSE r_name END AS official_language,
               substr(r_name, 1, 2) || 'D' AS currency_code,
               CASE WHEN r_name <> 'ASIA' THEN CAST(n_nationkey + 0.5 AS VARCHAR) END AS latitude,
               CAST(0 - n_nationkey AS VARCHAR) AS longitude
        FROM places WHERE r_name <> 'EUROPE'""",
    "geography": """
        SELECT n.n_nationkey AS geography_key, n.n_name AS country, n.r_name AS region,
               coalesce(nullif(trim(c.iso_code), ''),
                        CASE WHEN n.n_name = 'NATION_2' AND c.country IS NOT NULL THEN 'XX' END)
                 AS country_iso_code,
               nullif(trim(c.capital), '') AS country_capital,
               nullif(trim(c.official_language), '') AS country_language,
               nullif(trim(c.currency_code), '') AS country_currency,
               CAST(c.latitude AS DOUBLE) AS country_latitude,
               CAST(c.longitude AS DOUBLE) AS country_longitude
        FROM places n LEFT JOIN countries c
          ON c.country = CASE n.n_name WHEN 'NATION_1' THEN 'First Nation'
                                       WHEN 'NATION_2' THEN 'Second Nation' ELSE n.n_name END""",
    "raw_scores": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_acctbal < 0 THEN ''
                    ELSE CAST(CAST(floor(c_acctbal / 2500) AS BIGINT) AS VARCHAR) END AS score
        FROM customer
        UNION ALL
        SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN substr(o_orderpriority, 1, 1) END
        FROM orders""",
    "best_scores": """
        SELECT customer_id, CAST(max(CAST(score AS INTEGER)) AS INTEGER) AS score
        FROM raw_scores WHERE score IS NOT NULL AND score <> ''
        AND customer_id IN (SELECT c_custkey FROM customer)
        GROUP BY customer_id""",
    "scores": f"""
        SELECT c_custkey AS customer_id,
               CAST(least(floor(c_acctbal / 2000), 5) AS INTEGER) AS score
        FROM customer WHERE c_acctbal >= 0""",
    "check_log": """
        SELECT event_id AS id, 'table_' || CAST(user_id AS VARCHAR) AS tabla,
               CASE WHEN event_type <> 'view' THEN event_type END AS columna,
               CASE WHEN value < 50 THEN 'NOT_NULL' ELSE 'PK_NULOS' END AS tipo_chequeo,
               CASE WHEN event_type = 'signup' THEN 'check_raw' ELSE 'check_keys' END
                 AS nombre_script,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS fecha,
               CAST(floor(value) AS BIGINT) AS registros_afectados,
               value / 1000 AS indicador_calculado, CAST(0 AS DOUBLE) AS umbral_aplicado,
               CASE WHEN value >= 100 THEN 'ERROR' ELSE 'OK' END AS resultado
        FROM events""",
    "event_log": """
        SELECT 'table_' || CAST(user_id AS VARCHAR) AS tabla, upper(event_type) AS tipo_evento,
               'load' AS nombre_script, ts AS fecha_inicio, ts + INTERVAL 5 SECOND AS fecha_fin,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END
                 AS registros_procesados,
               CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS estado
        FROM events""",
}

def named_products(products: str) -> str:
    """Products with the names of their category and supplier and the stock alarm."""
    return f"""
        SELECT p.product_id, p.product_name, p.category_id, c.category_name, p.supplier_id,
               s.s_name AS supplier_name, p.quantity_per_unit, p.unit_price, p.units_in_stock,
               p.units_on_order, p.reorder_level, p.discontinued,
               CASE WHEN p.units_in_stock IS NULL OR p.units_in_stock <= 0 THEN 2
                    WHEN p.units_in_stock <= coalesce(p.reorder_level, 0) THEN 1
                    ELSE 0 END AS stock_alarm_level
        FROM {products} p
        LEFT JOIN categories c ON p.category_id = c.category_id
        LEFT JOIN supplier s ON p.supplier_id = s.s_suppkey"""


CTES["named_products"] = named_products("products")
CTES["base_named"] = named_products("base_products")
CTES["delta_named"] = named_products("delta_products")
SIGNATURE = (
    "coalesce(nullif(trim({country}), ''), '<unknown>') || '|' || "
    "coalesce(nullif(trim({region}), ''), '<none>') || '|' || "
    "coalesce(nullif(trim({city}), ''), '<none>') || '|' || "
    "coalesce(nullif(trim({postal}), ''), '<none>')"
)
PLACE = SIGNATURE.format(country="country", region="region", city="city", postal="postal_code")
SHIP = SIGNATURE.format(
    country="ship_country", region="ship_region", city="ship_city", postal="ship_postal_code"
)


def geography(headers: str) -> str:
    """One row per place signature."""
    return f"""
        SELECT {PLACE} AS geography_signature, min(country) AS country, min(region) AS region,
               min(city) AS city, min(postal_code) AS postal_code
        FROM (SELECT country, region, city, postal_code FROM customers
              UNION ALL SELECT country, region, city, NULL FROM employees
              UNION ALL SELECT ship_country, ship_region, ship_city, ship_postal_code
                        FROM {headers})
        GROUP BY 1"""


def days(headers: str) -> str:
    return f"""
        SELECT DISTINCT CAST(d AS DATE) AS full_date
        FROM (SELECT order_date AS d FROM {headers} UNION ALL
              SELECT required_date FROM {headers} UNION ALL SELECT shipped_date FROM {headers})
        WHERE d IS NOT NULL"""


CTES["all_places"] = geography("headers")
CTES["base_places"] = geography("base_headers")
CTES["early_places"] = geography("(SELECT * FROM base_headers WHERE employee_id < 20)")
CTES["all_days"] = days("headers")
CTES["base_days"] = days("base_headers")
CTES["delta_days"] = days("delta_headers")


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def date_row(d: str) -> str:
    return f"""{date_key(d)} AS date_key, {d} AS full_date,
        CAST(year({d}) AS INTEGER) AS year_number, CAST(quarter({d}) AS INTEGER) AS quarter_number,
        CAST(month({d}) AS INTEGER) AS month_number, CAST(day({d}) AS INTEGER) AS day_number"""


def sql(body: str, *more: tuple[str, str]) -> str:
    """Put the common tables a query names, directly or through others, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and _names(name, text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    own = dict(more)
    for definition in own.values():
        visit(definition)
    visit(body)
    parts = [f"{n} AS ({CTES[n]})" for n in needed] + [f"{n} AS ({d})" for n, d in own.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _names(name: str, text: str) -> bool:
    import re

    return re.search(rf"(FROM|JOIN)\s+{name}\b", text) is not None


# Checks ---------------------------------------------------------------------
def measured(
    table: str, column: str | None, kind: str, source: str, affected: str,
    total: str = "count(*)",
) -> str:
    label = "NULL" if column is None else f"'{column}'"
    return f"""SELECT '{table}' AS tabla, CAST({label} AS VARCHAR) AS columna,
        '{kind}' AS tipo_chequeo, CAST({total} AS BIGINT) AS total,
        CAST({affected} AS BIGINT) AS affected FROM {source}"""


def finished(step: str, *parts: str) -> str:
    return f"""
        SELECT tabla, columna, tipo_chequeo, '{step}' AS nombre_script, {BATCH} AS fecha,
               total AS total_filas_evaluadas, affected AS registros_afectados,
               CASE WHEN total > 0 THEN CAST(affected AS DOUBLE) / total ELSE 0.0 END
                 AS indicador_calculado,
               CAST(0 AS DOUBLE) AS umbral_aplicado,
               CASE WHEN affected = 0 THEN 'OK' ELSE 'ERROR' END AS resultado,
               tipo_chequeo || ' ' || concat_ws('.', tabla, columna) || ': ' || affected
                 || ' / ' || total AS detalle
        FROM ({' UNION ALL '.join(parts)})"""


def checks(*parts: str, step: str = "check", **tables: str) -> str:
    return sql(finished(step, *parts), *tables.items())


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_KEY = "CAST(o_orderkey AS VARCHAR)"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"
_DAY = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g')"


def _dirt(clean: str, low: str, high: str, urgent: str, medium: str) -> str:
    return f"""CASE WHEN o_orderstatus <> 'P' THEN {clean}
        WHEN o_orderpriority = '5-LOW' THEN {low} WHEN o_orderpriority = '2-HIGH' THEN {high}
        WHEN o_orderpriority = '1-URGENT' THEN {urgent}
        WHEN o_orderpriority = '3-MEDIUM' THEN {medium} ELSE {clean} END"""


RAW = f"""
    SELECT {_dirt(_KEY, f"'-' || {_KEY}", f"{_KEY} || chr(10)", "''", "NULL")} AS order_id,
           {_dirt(_PRICE, f"'-' || {_PRICE}", f"split_part({_PRICE}, '.', 1) || '.'", "'N/A'", _PRICE)}
             AS freight,
           CASE WHEN o_orderstatus <> 'O' THEN
           {_dirt(_DAY, f"substr({_DAY}, 1, 19)", f"{_DAY} || chr(10)", _DAY, "NULL")} END
             AS order_date
    FROM orders"""
HOLED = """
    SELECT CASE WHEN l_returnflag <> 'R' OR l_linestatus <> 'O' THEN l_orderkey END AS order_id,
           CASE WHEN l_returnflag <> 'A' OR l_linestatus <> 'F' THEN l_linenumber END
             AS line_number
    FROM lineitem"""


def bad(column: str, pattern: str) -> str:
    return count_if(f"{column} IS NOT NULL AND NOT regexp_matches({column}, '{pattern}')")


ORACLE["raw_to_typed"] = """
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS order_date,
           CAST(CAST(o_totalprice AS DECIMAL(12,4)) AS DOUBLE) AS freight,
           o_orderpriority AS ship_city
    FROM orders"""
ORACLE["check_format_integer"] = checks(
    measured("txt_orders", "order_id", "FORMATO_ENTERO", "raw", bad("order_id", r"^\d+$")),
    raw=RAW,
)
ORACLE["check_format_numeric"] = checks(
    measured("txt_orders", "freight", "FORMATO_NUMERICO", "raw", bad("freight", r"^\d+(\.\d+)?$")),
    raw=RAW,
)
ORACLE["check_format_timestamp"] = checks(
    measured(
        "txt_orders", "order_date", "FORMATO_TIMESTAMP", "raw",
        bad("order_date", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"),
    ),
    raw=RAW,
)
ORACLE["check_not_null"] = checks(
    measured("txt_customers", "company_name", "NOT_NULL", "customers", count_if("trim(city) = ''")),
    measured("txt_customers", "fax", "NOT_NULL", "customers", count_if("fax IS NULL")),
)
ORACLE["check_pk_nulls"] = checks(
    *[
        measured("txt_order_details", c, "PK_NULOS", "holed", count_if(f"{c} IS NULL"))
        for c in ("order_id", "line_number")
    ],
    holed=HOLED,
)
ORACLE["check_pk_duplicates_simple"] = checks(
    measured(
        "txt_order_details", "order_id", "PK_DUPLICADOS", "holed",
        "count(order_id) - count(DISTINCT order_id)", "count(order_id)",
    ),
    measured(
        "txt_customers", "customer_id", "PK_DUPLICADOS", "customers",
        "count(customer_id) - count(DISTINCT customer_id)", "count(customer_id)",
    ),
    holed=HOLED,
)
ORACLE["check_pk_duplicates_composite"] = checks(
    measured(
        "txt_order_details", "order_id|line_number", "PK_DUPLICADOS", "holed",
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT order_id, line_number FROM holed))",
    ),
    holed=HOLED,
)
_ASTRAY = """
    SELECT CASE WHEN l_returnflag = 'N' THEN NULL
                WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_partkey + 1000000000000
                ELSE l_partkey END AS product_id, CAST(l_orderkey AS VARCHAR) AS order_id
    FROM lineitem"""
_ORPHAN_PRODUCT = count_if(
    "product_id IS NOT NULL AND product_id NOT IN (SELECT p_partkey FROM part)"
)
ORACLE["check_foreign_keys"] = checks(
    measured(
        "tmp_order_details", "order_id → tmp_orders.order_id", "FK_INTEGRIDAD", "astray",
        count_if("order_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)"),
    ),
    measured(
        "tmp_order_details", "product_id → tmp_products.product_id", "FK_INTEGRIDAD", "astray",
        _ORPHAN_PRODUCT,
    ),
    measured(
        "tmp_order_details", "product_id -> tmp_products.product_id", "DWA_JOIN_DIMENSION",
        "astray", _ORPHAN_PRODUCT,
    ),
    astray=_ASTRAY,
)
ORACLE["check_self_reference"] = checks(
    measured(
        "tmp_employees", "reports_to → tmp_employees.employee_id", "FK_INTEGRIDAD", "people",
        count_if("reports_to IS NOT NULL AND reports_to NOT IN (SELECT c_custkey FROM customer)"),
    ),
    people="""SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey * 2 - c_nationkey END AS reports_to
              FROM customer""",
)
ORACLE["check_fact_grain"] = checks(
    measured(
        "tmp_order_details", "order_id|product_id", "DWA_GRANO_FACT",
        "(SELECT count(*) AS n FROM details GROUP BY order_id, product_id)",
        "coalesce(sum(n - 1), 0)", "sum(n)",
    )
)
ORACLE["check_fact_grain_of_load"] = ORACLE["check_fact_grain"]
ORACLE["check_measures"] = checks(
    measured(
        "tmp_order_details", "unit_price|quantity|discount", "DWA_MEDIDA_VALIDA", "details",
        count_if(
            "unit_price IS NULL OR quantity IS NULL OR discount IS NULL OR quantity <= 0 "
            "OR discount < 0 OR discount > 1"
        ),
    )
)
ORACLE["check_stock"] = checks(
    measured(
        "tmp_products", "units_in_stock|units_on_order|reorder_level", "DWA_STOCK_VALIDO",
        "products",
        count_if(
            "units_in_stock IS NULL OR units_on_order IS NULL OR reorder_level IS NULL OR "
            "units_in_stock < 0 OR units_on_order < 0 OR reorder_level < 0"
        ),
    )
)
ORACLE["check_required_text"] = checks(
    *[
        measured(t, c, "DWA_GEOGRAFIA_REQUERIDA", s, count_if(f"nullif(trim({c}), '') IS NULL"))
        for t, s, c in (
            ("tmp_customers", "customers", "city"),
            ("tmp_customers", "customers", "country"),
            ("tmp_orders", "headers", "ship_region"),
        )
    ]
)
ORACLE["check_required_date"] = checks(
    *[
        measured("tmp_orders", c, "DWA_FECHA_REQUERIDA", "headers", count_if(f"{c} IS NULL"))
        for c in ("order_date", "required_date", "shipped_date")
    ]
)
_EMPTY = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"
_NO_PART = "(SELECT * FROM part WHERE p_size < 0)"
ORACLE["check_non_empty"] = checks(
    measured("tmp_orders", None, "DWA_FUENTE_NO_VACIA", "orders", _EMPTY, "1"),
    measured("tmp_order_details", None, "DWA_FUENTE_NO_VACIA", "lineitem", _EMPTY, "1"),
    measured("tmp_products", None, "DWA_FUENTE_NO_VACIA", _NO_PART, _EMPTY, "1"),
    measured(
        "dp02_dqm_*", None, "DP02_NO_VACIO",
        f"""(SELECT count(*) AS n FROM orders UNION ALL SELECT count(*) FROM lineitem
             UNION ALL SELECT count(*) FROM {_NO_PART})""",
        count_if("n = 0"), "3",
    ),
)
ORACLE["check_row_reconciliation"] = checks(
    measured(
        "dwa_fact_order_lines", None, "DWA_CONTEO_FACT", "lineitem",
        """abs(count(*) - (SELECT count(*) FROM
               (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)))""",
    )
)


def _latest(where: str, keys: str = "nombre_script, tabla, columna, tipo_chequeo") -> str:
    return f"""(SELECT * FROM check_log WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY fecha DESC, id DESC) = 1)"""


_ERRORS = count_if("resultado = 'ERROR'")
ORACLE["check_previous_errors"] = sql(
    finished(
        "check",
        measured(
            "DWA", None, "DWA_SIN_ERRORES_PREVIOS", _latest("nombre_script = 'check_raw'"), _ERRORS
        ),
        measured("none", None, "DWA_SIN_ERRORES_PREVIOS", "(SELECT 1)", "1", "1"),
    )
    + " UNION ALL "
    + finished(
        "check_raw",
        measured(
            "dqm_validaciones", "resultado", "DQM_SIN_ERRORES_PREVIOS",
            _latest("nombre_script <> 'check_raw'"), _ERRORS, f"greatest({_ERRORS}, 1)",
        ),
    )
)
ORACLE["errors_by_table"] = sql(
    "SELECT tabla, count(*) AS errores FROM check_log WHERE resultado = 'ERROR' GROUP BY tabla"
)
_LAST = _latest("true", "tabla, columna, tipo_chequeo")
ORACLE["latest_check_status"] = sql(f"SELECT count(*) AS total, {_ERRORS} AS errores FROM {_LAST}")
ORACLE["latest_checks"] = sql(f"SELECT id, tabla, columna, tipo_chequeo, resultado FROM {_LAST}")


# Profiles -------------------------------------------------------------------
def _profile(table: str, source: str, column: str | None, expression: str = "") -> str:
    head = f"""SELECT '{table}' AS tabla, CAST({f"'{column}'" if column else 'NULL'} AS VARCHAR)
        AS columna, 'profile' AS nombre_script, {BATCH} AS fecha, count(*) AS total_filas"""
    e = expression or column
    figures = (
        f"""count(*) - count({e}) AS nulos, count(DISTINCT {e}) AS valores_distintos,
            CAST(min({e}) AS VARCHAR) AS valor_minimo, CAST(max({e}) AS VARCHAR) AS valor_maximo"""
        if column
        else """CAST(NULL AS BIGINT) AS nulos, CAST(NULL AS BIGINT) AS valores_distintos,
            CAST(NULL AS VARCHAR) AS valor_minimo, CAST(NULL AS VARCHAR) AS valor_maximo"""
    )
    return f"""{head}, {figures}, CAST(0 AS BIGINT) AS outliers_detectados,
        CAST(NULL AS VARCHAR) AS observaciones FROM {source}"""


_CUSTOMER_COLUMNS = "customer_id company_name contact_title city region country fax".split()
_ORDER_COLUMNS = {
    "order_id": "", "customer_id": "", "order_date": "CAST(order_date AS DATE)",
    "shipped_date": "CAST(shipped_date AS DATE)", "ship_country": "", "ship_city": "",
}
PROFILES = " UNION ALL ".join(
    [_profile("tmp_customers", "customers", None)]
    + [_profile("tmp_customers", "customers", c) for c in _CUSTOMER_COLUMNS]
    + [_profile("tmp_orders", "headers", None)]
    + [_profile("tmp_orders", "headers", c, e) for c, e in _ORDER_COLUMNS.items()]
)
CTES["profiles"] = PROFILES
ORACLE["profile_columns"] = sql(PROFILES)
_MERGED = " UNION ALL ".join(
    [_profile("tmp_orders", "headers", None)]
    + [
        _profile("tmp_orders", "headers", c)
        for c in "order_id ship_city ship_postal_code employee_id ship_via ship_country".split()
    ]
)
ORACLE["profile_merged"] = sql(
    f"""SELECT * REPLACE (CASE WHEN columna = 'order_id' THEN NULL ELSE valores_distintos END
                          AS valores_distintos),
               CASE WHEN columna = 'order_id' THEN true END AS cercano
        FROM ({_MERGED})"""
)

# Dimensions -----------------------------------------------------------------
ORACLE["dim_date"] = sql(f"SELECT {date_row('full_date')} FROM all_days")
ORACLE["dim_date_extend"] = sql(
    f"""SELECT {date_row('full_date')} FROM delta_days
        WHERE full_date NOT IN (SELECT full_date FROM base_days)"""
)
ORACLE["dim_geography"] = sql("SELECT * FROM all_places")
ORACLE["dim_geography_extend"] = sql(
    f"""SELECT {SHIP} AS geography_signature, min(ship_country) AS country,
               min(ship_region) AS region, min(ship_city) AS city,
               min(ship_postal_code) AS postal_code
        FROM delta_headers
        WHERE {SHIP} NOT IN (SELECT geography_signature FROM early_places)
        GROUP BY 1"""
)
_ATTRIBUTES = "company_name, contact_name, contact_title, city, region, postal_code, country, phone, fax"
ORACLE["dim_customer"] = sql(
    f"""SELECT customer_id, geography_signature AS customer_geography_key,
               {', '.join('c.' + a.strip() for a in _ATTRIBUTES.split(','))}
        FROM customers c JOIN (SELECT geography_signature FROM all_places) g
          ON geography_signature = {SIGNATURE.format(
              country='c.country', region='c.region', city='c.city', postal='c.postal_code')}"""
)
ORACLE["dim_customer_extend"] = sql(
    f"""SELECT customer_id, geography_signature AS customer_geography_key,
               {', '.join('c.' + a.strip() for a in _ATTRIBUTES.split(','))}
        FROM delta_customers c JOIN (SELECT geography_signature FROM all_places) g
          ON geography_signature = {SIGNATURE.format(
              country='c.country', region='c.region', city='c.city', postal='c.postal_code')}
        WHERE customer_id NOT IN (SELECT customer_id FROM base_customers)"""
)
ORACLE["dim_employee"] = sql(
    f"""SELECT employee_id, geography_signature AS employee_geography_key,
               first_name || ' ' || last_name AS employee_name, title, e.city, e.region,
               e.country, reports_to
        FROM employees e JOIN (SELECT geography_signature FROM all_places) g
          ON geography_signature = {SIGNATURE.format(
              country='e.country', region='e.region', city='e.city', postal="''")}"""
)
ORACLE["dim_shipper"] = """
    SELECT r_regionkey AS shipper_id, r_name AS company_name, CAST(NULL AS VARCHAR) AS phone
    FROM region"""
ORACLE["dim_product"] = sql(
    "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM named_products"
)
_BUCKET = "substr(md5(CAST(customer_id AS VARCHAR)), 1, 3)"
ORACLE["surrogate_keys"] = sql(
    f"""SELECT row_number() OVER (ORDER BY {_BUCKET}, customer_id) AS customer_key, customer_id
        FROM base_customers
        UNION ALL
        SELECT (SELECT count(*) FROM base_customers)
                 + row_number() OVER (ORDER BY {_BUCKET}, customer_id), customer_id
        FROM customers WHERE contact_title = 'FURNITURE'"""
)


# Fact -----------------------------------------------------------------------
def amounts(gross: str, discount: str, prefix: str = "") -> str:
    return f"""CAST({gross} * {discount} AS DOUBLE) AS {prefix}discount_amount,
        CAST({gross} * (1 - {discount}) AS DOUBLE) AS {prefix}net_amount"""


_ZERO = "coalesce(discount, CAST(0 AS DECIMAL(4,2)))"
ORACLE["line_amounts"] = sql(
    f"""SELECT order_id, product_id, line_number, CAST(gross AS DOUBLE) AS gross_amount,
               {amounts('gross', _ZERO)}, {amounts('gross', 'discount', 'delta_')}
        FROM (SELECT d.order_id, d.product_id, d.line_number, d.discount,
                     p.unit_price * d.quantity AS gross
              FROM details d JOIN products p ON d.product_id = p.product_id)"""
)


def _fact(headers: str, places: str, days_: str, join: str, shippers: str, discount: str) -> str:
    return f"""
        SELECT d.order_id, d.product_id, c.c_custkey AS customer_key,
               p.p_partkey AS product_key, e.n_nationkey AS employee_key,
               s.r_regionkey AS shipper_key, g.geography_signature AS ship_geography_key,
               {date_key('o.full_date')} AS order_date_key,
               {date_key('r.full_date')} AS required_date_key,
               {date_key('x.full_date')} AS shipped_date_key,
               CAST(d.unit_price AS DOUBLE) AS unit_price, d.quantity,
               CAST({discount} AS DOUBLE) AS discount,
               CAST(d.gross_amount AS DOUBLE) AS gross_amount,
               {amounts('d.gross_amount', discount)},
               CAST(h.freight AS DOUBLE) AS order_freight_amount
        FROM details d
        JOIN (SELECT *, {SHIP} AS signature FROM {headers}) h ON d.order_id = h.order_id
        JOIN customer c ON h.customer_id = c.c_custkey
        JOIN part p ON d.product_id = p.p_partkey
        {join} nation e ON h.employee_id = e.n_nationkey
        {join} {shippers} s ON h.ship_via = s.r_regionkey
        {join} {places} g ON h.signature = g.geography_signature
        {join} {days_} o ON CAST(h.order_date AS DATE) = o.full_date
        {join} {days_} r ON CAST(h.required_date AS DATE) = r.full_date
        LEFT JOIN {days_} x ON CAST(h.shipped_date AS DATE) = x.full_date"""


ORACLE["fact_lines"] = sql(
    _fact("headers", "all_places", "all_days", "JOIN", "region", _ZERO)
)
ORACLE["fact_lines_delta"] = sql(
    _fact(
        "delta_headers", "base_places", "base_days", "LEFT JOIN",
        "(SELECT * FROM region WHERE r_regionkey < 3)", "discount",
    )
)
ORACLE["fact_insert_ignore"] = sql(
    """SELECT order_id, product_id, line_number, CAST(unit_price AS DOUBLE) AS unit_price,
              quantity, CAST(discount AS DOUBLE) AS discount,
              CAST(gross_amount AS DOUBLE) AS gross_amount
       FROM details d
       WHERE NOT EXISTS (SELECT 1 FROM details x JOIN base_headers h ON x.order_id = h.order_id
                         WHERE x.order_id = d.order_id AND x.product_id = d.product_id)
       QUALIFY row_number() OVER (PARTITION BY order_id, product_id
                                  ORDER BY line_number, gross_amount, quantity,
                                           d.discount NULLS FIRST) = 1"""
)
ORACLE["fact_insert_ranges"] = sql(
    """SELECT order_id, product_id, line_number, CAST(unit_price AS DOUBLE) AS unit_price,
              quantity, CAST(discount AS DOUBLE) AS discount,
              CAST(gross_amount AS DOUBLE) AS gross_amount
       FROM details d
       WHERE line_number >= 3
         AND NOT EXISTS (SELECT 1 FROM details x JOIN base_headers h ON x.order_id = h.order_id
                         WHERE x.line_number < 3 AND x.order_id = d.order_id
                           AND x.product_id = d.product_id)
       QUALIFY row_number() OVER (PARTITION BY order_id, product_id
                                  ORDER BY line_number, gross_amount, quantity,
                                           d.discount NULLS FIRST) = 1"""
)
ORACLE["dropped_lines"] = sql(
    """SELECT order_id, product_id, line_number, quantity FROM details
       WHERE order_id NOT IN (SELECT order_id FROM delta_headers WHERE customer_id IN
                                (SELECT customer_id FROM base_customers))
          OR product_id NOT IN (SELECT product_id FROM base_products)"""
)
ORACLE["order_freight"] = sql(
    """SELECT order_id, CAST(freight AS DOUBLE) AS order_freight_amount FROM headers
       WHERE order_id IN (SELECT l_orderkey FROM lineitem)"""
)

# History --------------------------------------------------------------------
_NAMES = [a.strip() for a in _ATTRIBUTES.split(",")]


def _signature(names: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({n} AS VARCHAR), '')" for n in names)


_OPEN = """CAST(NULL AS TIMESTAMP) AS vigente_hasta, CAST(1 AS INTEGER) AS es_vigente"""
_VERSION = f"customer_id, {_ATTRIBUTES}, {_signature(_NAMES)} AS attribute_signature"
CTES["old_versions"] = f"SELECT {_VERSION}, {LOAD} AS vigente_desde FROM base_customers"
CTES["new_versions"] = f"SELECT {_VERSION}, {BATCH} AS vigente_desde FROM delta_customers"
CTES["opened"] = """
    SELECT n.* FROM new_versions n
    WHERE NOT EXISTS (SELECT 1 FROM old_versions o WHERE o.customer_id = n.customer_id
                      AND o.attribute_signature = n.attribute_signature)"""
ORACLE["scd2_init"] = sql(f"SELECT *, {_OPEN} FROM old_versions")
ORACLE["scd2_apply"] = sql(
    f"""SELECT o.*,
               CASE WHEN n.customer_id IS NOT NULL THEN {BATCH} END AS vigente_hasta,
               CAST(CASE WHEN n.customer_id IS NOT NULL THEN 0 ELSE 1 END AS INTEGER)
                 AS es_vigente
        FROM old_versions o LEFT JOIN (SELECT customer_id FROM opened) n
          ON o.customer_id = n.customer_id
        UNION ALL BY NAME SELECT *, {_OPEN} FROM opened"""
)
ORACLE["scd1_update"] = sql(
    f"""SELECT b.customer_id,
               {', '.join(
                   f'CASE WHEN n.customer_id IS NULL THEN b.{a} ELSE n.{a} END AS {a}'
                   for a in _NAMES)}
        FROM base_customers b LEFT JOIN opened n ON b.customer_id = n.customer_id"""
)
_PRODUCT_NAMES = (
    "product_name category_id category_name supplier_id supplier_name quantity_per_unit "
    "unit_price units_in_stock units_on_order reorder_level discontinued"
).split()
ORACLE["scd2_product_init"] = sql(
    f"""SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price),
               {_signature(_PRODUCT_NAMES)} AS attribute_signature, {LOAD} AS vigente_desde,
               {_OPEN}
        FROM named_products"""
)
_PRODUCT_VERSION = f"""* REPLACE (CAST(unit_price AS DOUBLE) AS unit_price),
    {_signature(_PRODUCT_NAMES)} AS attribute_signature"""
CTES["old_products"] = f"SELECT {_PRODUCT_VERSION}, {LOAD} AS vigente_desde FROM base_named"
CTES["new_products"] = f"SELECT {_PRODUCT_VERSION}, {BATCH} AS vigente_desde FROM delta_named"
CTES["opened_products"] = """
    SELECT n.* FROM new_products n
    WHERE NOT EXISTS (SELECT 1 FROM old_products o WHERE o.product_id = n.product_id
                      AND o.attribute_signature = n.attribute_signature)"""
ORACLE["scd2_product_apply"] = sql(
    f"""SELECT o.*,
               CASE WHEN n.product_id IS NOT NULL THEN {BATCH} END AS vigente_hasta,
               CAST(CASE WHEN n.product_id IS NOT NULL THEN 0 ELSE 1 END AS INTEGER)
                 AS es_vigente
        FROM old_products o LEFT JOIN (SELECT product_id FROM opened_products) n
          ON o.product_id = n.product_id
        UNION ALL BY NAME SELECT *, {_OPEN} FROM opened_products"""
)
ORACLE["scd1_product_update"] = sql(
    """SELECT d.* REPLACE (CAST(d.unit_price AS DOUBLE) AS unit_price)
       FROM delta_named d JOIN base_products b ON d.product_id = b.product_id"""
)

# Metrics --------------------------------------------------------------------
_SUMS = """CAST(sum(gross) AS DOUBLE) AS gross_amount,
    CAST(sum(discounted) AS DOUBLE) AS discount_amount, CAST(sum(net) AS DOUBLE) AS net_amount"""
ORACLE["customer_sales_metrics"] = sql(
    f"""SELECT customer_id AS customer_key, customer_id,
               count(*) AS order_count, CAST(sum(lines) AS BIGINT) AS order_line_count,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, {_SUMS},
               CAST(sum(net) AS DOUBLE) / count(*) AS avg_order_net_amount,
               min(day) AS first_order_date, max(day) AS last_order_date
        FROM (SELECT customer_id, order_id, min(day) AS day, count(*) AS lines,
                     sum(quantity) AS quantity, sum(gross) AS gross,
                     sum(discounted) AS discounted, sum(net) AS net
              FROM sales GROUP BY customer_id, order_id)
        GROUP BY customer_id"""
)
ORACLE["product_sales_metrics"] = sql(
    f"""SELECT product_id AS product_key, product_id,
               count(DISTINCT order_id) AS order_count, count(*) AS order_line_count,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, {_SUMS},
               CAST(sum(net) AS DOUBLE) / count(*) AS avg_line_net_amount,
               min(day) AS first_order_date, max(day) AS last_order_date
        FROM sales JOIN part ON product_id = p_partkey GROUP BY product_id"""
)
ORACLE["customer_metrics_after_delta"] = ORACLE["customer_sales_metrics"]
ORACLE["product_metrics_after_delta"] = ORACLE["product_sales_metrics"]

# Enrichment -----------------------------------------------------------------
ORACLE["enrich_geography"] = sql("SELECT * FROM geography")
ORACLE["score_best_per_customer"] = sql(
    "SELECT customer_id AS customer_key, customer_id, score FROM best_scores"
)
ORACLE["score_upsert"] = sql(
    f"""SELECT customer_id AS customer_key, customer_id,
               CASE WHEN b.customer_id IS NULL THEN t.score ELSE b.score END AS score,
               CASE WHEN b.customer_id IS NULL THEN {LOAD} ELSE {BATCH} END AS fecha_carga
        FROM (SELECT s.* FROM scores s JOIN customer ON c_custkey = s.customer_id
              WHERE c_acctbal > 5000) t
        FULL JOIN best_scores b USING (customer_id)"""
)

# Publication ----------------------------------------------------------------
CTES["dp01"] = """
    SELECT anio, mes, CAST(anio AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0')
             AS periodo,
           ship_country, country_iso_code, country_capital, country_language, country_currency,
           country_latitude, country_longitude, score_segment, score_segment_order,
           count(DISTINCT customer_id) AS clientes_distintos,
           count(DISTINCT order_id) AS ordenes, count(*) AS lineas_orden,
           CAST(sum(quantity) AS BIGINT) AS cantidad_total,
           CAST(sum(gross) AS DOUBLE) AS gross_amount,
           CAST(sum(discounted) AS DOUBLE) AS discount_amount,
           CAST(sum(net) AS DOUBLE) AS net_amount, sum(net) AS exact_net,
           CAST(sum(net) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_net_amount
    FROM (SELECT s.*, CAST(year(day) AS INTEGER) AS anio, CAST(month(day) AS INTEGER) AS mes,
                 coalesce(g.country, '<sin_pais>') AS ship_country, g.country_iso_code,
                 g.country_capital, g.country_language, g.country_currency, g.country_latitude,
                 g.country_longitude,
                 CASE WHEN c.score IS NULL THEN 'sin_score' WHEN c.score >= 4 THEN 'alto_4_5'
                      WHEN c.score >= 2 THEN 'medio_2_3' ELSE 'bajo_0_1' END AS score_segment,
                 CASE WHEN c.score IS NULL THEN 4 WHEN c.score >= 4 THEN 1
                      WHEN c.score >= 2 THEN 2 ELSE 3 END AS score_segment_order
          FROM sales s JOIN geography g ON s.nation = g.geography_key
          LEFT JOIN scores c ON s.customer_id = c.customer_id)
    GROUP BY ALL"""
# GROUP BY ALL groups by every column that is not an aggregate.
ORACLE["dp01_sales_geo_score"] = sql("SELECT * EXCLUDE (exact_net) FROM dp01")
ORACLE["dp01_from_state"] = ORACLE["dp01_sales_geo_score"]
ORACLE["check_published"] = checks(
    measured("dp01_ventas_geo_score", None, "DP01_NO_VACIO", "dp01", _EMPTY, "1"),
    measured(
        "dp01_ventas_geo_score", "score_segment", "DP01_SCORE_ENRIQUECIDO", "dp01",
        f"CASE WHEN {count_if('score_segment <> ' + chr(39) + 'sin_score' + chr(39))} = 0 "
        "THEN 1 ELSE 0 END", "1",
    ),
    measured(
        "dp01_ventas_geo_score",
        "country_iso_code|country_currency|country_latitude|country_longitude",
        "DP01_GEOGRAFIA_ENRIQUECIDA", "dp01",
        count_if(
            "country_iso_code IS NULL OR country_currency IS NULL OR country_latitude IS NULL "
            "OR country_longitude IS NULL"
        ),
    ),
    measured(
        "dp01_ventas_geo_score", "ordenes|lineas_orden|cantidad_total|net_amount",
        "DP01_MEDIDAS_VALIDAS", "dp01",
        count_if("ordenes <= 0 OR lineas_orden <= 0 OR cantidad_total <= 0 OR net_amount < 0"),
    ),
)


def _dp02_checks(source: str) -> str:
    return f"""
        SELECT nombre_script, tabla, columna, tipo_chequeo, resultado, count(*) AS checks,
               CAST(coalesce(sum(registros_afectados), 0) AS BIGINT) AS registros_afectados_total,
               max(indicador_calculado) AS indicador_maximo,
               max(umbral_aplicado) AS umbral_maximo, max(fecha) AS ultima_fecha
        FROM {source} GROUP BY ALL"""


CTES["dp02_c"] = _dp02_checks("check_log")
CTES["dp02_e"] = """
    SELECT nombre_script, tabla, tipo_evento, estado, count(*) AS eventos,
           CAST(coalesce(sum(registros_procesados), 0) AS BIGINT) AS registros_procesados_total,
           min(fecha_inicio) AS primera_ejecucion, max(fecha_fin) AS ultima_ejecucion
    FROM event_log GROUP BY ALL"""


def _dp02_profiles(source: str) -> str:
    return f"""
        SELECT tabla, count(DISTINCT columna) AS columnas_perfiladas,
               max(total_filas) AS total_filas_maximo,
               CAST(coalesce(sum(nulos), 0) AS BIGINT) AS nulos_total,
               CAST(coalesce(sum(valores_distintos), 0) AS BIGINT) AS valores_distintos_total,
               CAST(coalesce(sum(outliers_detectados), 0) AS BIGINT) AS outliers_total,
               max(fecha) AS ultima_fecha
        FROM {source} GROUP BY tabla"""


CTES["dp02_p"] = _dp02_profiles("profiles")
ORACLE["dp02_checks"] = sql("SELECT * FROM dp02_c")
_RAW_LOG = "(SELECT * FROM check_log WHERE nombre_script = 'check_raw')"
ORACLE["dp02_step_checks"] = sql(
    _dp02_checks(
        f"(SELECT * FROM {_RAW_LOG} WHERE fecha = (SELECT max(fecha) FROM {_RAW_LOG}))"
    )
)
ORACLE["dp02_events"] = sql("SELECT * FROM dp02_e")
ORACLE["dp02_profiles"] = sql("SELECT * FROM dp02_p")
_WITH_NULLS = "(SELECT * FROM profiles WHERE nulos > 0)"
_ODD = """(SELECT * FROM profiles
           WHERE nulos > 0 AND valores_distintos = 0 AND nulos < total_filas)"""


def _or_default(case: str, rows: str) -> str:
    return f"""SELECT *, '{case}' AS caso FROM ({_dp02_profiles(rows)}
        UNION ALL
        SELECT 'sin_perfilado_disponible', 0, 0, 0, 0, 0, {BATCH}
        WHERE NOT EXISTS (SELECT * FROM {rows}))"""


ORACLE["dp02_profiles_default"] = sql(
    f"{_or_default('con_nulos', _WITH_NULLS)} UNION ALL {_or_default('sin_valores', _ODD)}"
)

# Dashboards -----------------------------------------------------------------
ORACLE["dash_kpis"] = sql(
    """SELECT count(*) AS filas_dp, count(DISTINCT ship_country) AS paises,
              CAST(sum(ordenes) AS BIGINT) AS ordenes, CAST(sum(lineas_orden) AS BIGINT) AS lineas,
              CAST(sum(exact_net) AS DOUBLE) AS venta_neta
       FROM dp01"""
)
CTES["top_countries"] = """
    SELECT ship_country, country_iso_code, CAST(sum(ordenes) AS BIGINT) AS ordenes,
           CAST(sum(exact_net) AS DOUBLE) AS venta_neta
    FROM dp01 GROUP BY ALL
    ORDER BY sum(exact_net) DESC, ship_country, country_iso_code LIMIT 10"""
ORACLE["dash_top_countries"] = sql("SELECT * FROM top_countries")
ORACLE["dash_segments"] = sql(
    """SELECT score_segment,
              CASE score_segment WHEN 'alto_4_5' THEN 'Alto (4-5)'
                WHEN 'medio_2_3' THEN 'Medio (2-3)' WHEN 'bajo_0_1' THEN 'Bajo (0-1)'
                WHEN 'sin_score' THEN 'Sin score' ELSE score_segment END AS score_segment_label,
              min(score_segment_order) AS orden, CAST(sum(ordenes) AS BIGINT) AS ordenes,
              CAST(sum(exact_net) AS DOUBLE) AS venta_neta
       FROM dp01 GROUP BY score_segment"""
)
ORACLE["dash_monthly"] = sql(
    """SELECT periodo, CAST(sum(ordenes) AS BIGINT) AS ordenes,
              CAST(sum(exact_net) AS DOUBLE) AS venta_neta
       FROM dp01 GROUP BY periodo"""
)
ORACLE["dash_bars"] = sql(
    """SELECT ship_country, venta_neta,
              greatest(2, CAST(trunc(venta_neta / max(venta_neta) OVER () * 100) AS INTEGER))
                AS width
       FROM top_countries"""
)
ORACLE["dash_check_status"] = sql(
    """SELECT resultado, CAST(sum(checks) AS BIGINT) AS checks,
              CAST(sum(registros_afectados_total) AS BIGINT) AS afectados
       FROM dp02_c GROUP BY resultado"""
)
ORACLE["dash_event_status"] = sql(
    """SELECT estado, CAST(sum(eventos) AS BIGINT) AS eventos,
              CAST(sum(registros_procesados_total) AS BIGINT) AS procesados
       FROM dp02_e GROUP BY estado"""
)
ORACLE["dash_top_profiles"] = sql(
    """SELECT tabla, columnas_perfiladas, total_filas_maximo, nulos_total, outliers_total
       FROM dp02_p ORDER BY total_filas_maximo DESC NULLS LAST, tabla LIMIT 15"""
)
ORACLE["dash_recent_checks"] = sql(
    """SELECT nombre_script, tabla, tipo_chequeo, resultado, registros_afectados_total,
              ultima_fecha
       FROM dp02_c
       ORDER BY ultima_fecha DESC NULLS LAST, nombre_script, tabla, columna NULLS FIRST,
                tipo_chequeo, resultado LIMIT 15"""
)
ORACLE["dash_display"] = sql(
    """SELECT order_id, '$' || format('{:,.2f}', CAST(freight AS DOUBLE)) AS freight,
              format('{:,.2f}', CAST(freight AS DOUBLE)) AS amount,
              coalesce(strftime(shipped_date, '%Y-%m-%d %H:%M:%S'), '') AS shipped
       FROM headers"""
)
