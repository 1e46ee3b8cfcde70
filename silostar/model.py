"""Declared inputs: the files, their columns, casts, keys and foreign keys.

Checks, typed projections and profiles are all derived from these declarations.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

INT = "int"
ID = "bigint"  # identifiers outgrow 32 bits long before the rest does
TS = "timestamp_ntz"
# Wide enough that price * quantity * (1 - discount) keeps every digit.
MONEY = "decimal(12,4)"
RATIO = "decimal(12,10)"


@dataclass(frozen=True)
class Source:
    """One delimited input file and the typed table made from it."""

    name: str
    file: str
    columns: tuple[str, ...]
    casts: Mapping[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    separator: str = ","

    @property
    def raw_table(self) -> str:
        return f"txt_{self.name}"

    @property
    def staged_table(self) -> str:
        return f"tmp_{self.name}"

    @property
    def typed_columns(self) -> dict[str, str]:
        return {c: self.casts.get(c, "string") for c in self.columns if c not in self.dropped}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parents: tuple[str, ...]
    parent_column: str


# Input files --------------------------------------------------
_COMPANY = tuple(
    "company_name contact_name contact_title address city region postal_code country phone fax".split()
)

CATEGORIES = Source(
    "categories", "categories.csv",
    ("category_id", "category_name", "description", "picture"),
    {"category_id": ID}, ("category_id",), ("category_name",), ("picture",),
)
SUPPLIERS = Source(
    "suppliers", "suppliers.csv", ("supplier_id", *_COMPANY, "home_page"),
    {"supplier_id": ID}, ("supplier_id",), ("company_name",),
)
SHIPPERS = Source(
    "shippers", "shippers.csv", ("shipper_id", "company_name", "phone"),
    {"shipper_id": ID}, ("shipper_id",), ("company_name",),
)
REGIONS = Source(
    "regions", "regions.csv", ("region_id", "region_description"),
    {"region_id": ID}, ("region_id",), ("region_description",),
)
CUSTOMERS = Source(
    "customers", "customers.csv", ("customer_id", *_COMPANY),
    {}, ("customer_id",), ("company_name",), separator=";",
)
EMPLOYEES = Source(
    "employees", "employees.csv",
    tuple(
        "employee_id last_name first_name title title_of_courtesy birth_date hire_date address "
        "city region postal_code country home_phone extension photo notes reports_to "
        "photo_path".split()
    ),
    {"employee_id": ID, "reports_to": ID, "birth_date": TS, "hire_date": TS},
    ("employee_id",), ("last_name", "first_name"), ("photo",),
)
PRODUCTS = Source(
    "products", "products.csv",
    tuple(
        "product_id product_name supplier_id category_id quantity_per_unit unit_price "
        "units_in_stock units_on_order reorder_level discontinued".split()
    ),
    {
        "product_id": ID, "supplier_id": ID, "category_id": ID, "unit_price": MONEY,
        "units_in_stock": INT, "units_on_order": INT, "reorder_level": INT,
        "discontinued": INT,
    },
    ("product_id",), ("product_name",),
)
TERRITORIES = Source(
    # territory_id keeps its leading zeros, so it stays text
    "territories", "territories.csv", ("territory_id", "territory_description", "region_id"),
    {"region_id": ID}, ("territory_id",), ("territory_description",),
)
EMPLOYEE_TERRITORIES = Source(
    "employee_territories", "employee_territories.csv", ("employee_id", "territory_id"),
    {"employee_id": ID}, ("employee_id", "territory_id"),
)
ORDERS = Source(
    "orders", "orders.csv",
    tuple(
        "order_id customer_id employee_id order_date required_date shipped_date ship_via "
        "freight ship_name ship_address ship_city ship_region ship_postal_code "
        "ship_country".split()
    ),
    {
        "order_id": ID, "employee_id": ID, "ship_via": ID, "order_date": TS,
        "required_date": TS, "shipped_date": TS, "freight": MONEY,
    },
    ("order_id",),
)
ORDER_DETAILS = Source(
    "order_details", "order_details.csv",
    ("order_id", "product_id", "unit_price", "quantity", "discount"),
    {"order_id": ID, "product_id": ID, "unit_price": MONEY, "quantity": INT, "discount": RATIO},
    ("order_id", "product_id"),
)

INDEPENDENT = (CATEGORIES, SUPPLIERS, SHIPPERS, REGIONS, CUSTOMERS)
DEPENDENT = (EMPLOYEES, PRODUCTS, TERRITORIES, EMPLOYEE_TERRITORIES, ORDERS, ORDER_DETAILS)
INITIAL = INDEPENDENT + DEPENDENT

CUSTOMERS_DELTA = replace(
    CUSTOMERS, name="customers_nov", file="customers - novedades.csv", separator=","
)
PRODUCTS_DELTA = replace(PRODUCTS, name="products_nov", file="products - novedades.csv")
ORDERS_DELTA = replace(
    ORDERS, name="orders_nov", file="orders - novedades.csv", not_null=("customer_id",)
)
ORDER_DETAILS_DELTA = replace(
    ORDER_DETAILS, name="order_details_nov", file="order_details - novedades.csv"
)
DELTA = (CUSTOMERS_DELTA, PRODUCTS_DELTA, ORDERS_DELTA, ORDER_DETAILS_DELTA)

INITIAL_KEYS = (
    ForeignKey("employees", "reports_to", ("employees",), "employee_id"),
    ForeignKey("products", "supplier_id", ("suppliers",), "supplier_id"),
    ForeignKey("products", "category_id", ("categories",), "category_id"),
    ForeignKey("territories", "region_id", ("regions",), "region_id"),
    ForeignKey("employee_territories", "employee_id", ("employees",), "employee_id"),
    ForeignKey("employee_territories", "territory_id", ("territories",), "territory_id"),
    ForeignKey("orders", "customer_id", ("customers",), "customer_id"),
    ForeignKey("orders", "employee_id", ("employees",), "employee_id"),
    ForeignKey("orders", "ship_via", ("shippers",), "shipper_id"),
    ForeignKey("order_details", "order_id", ("orders",), "order_id"),
    ForeignKey("order_details", "product_id", ("products",), "product_id"),
)
# New customers and products may arrive in the same delta, so both parents count.
DELTA_KEYS = (
    ForeignKey("products_nov", "supplier_id", ("suppliers",), "supplier_id"),
    ForeignKey("products_nov", "category_id", ("categories",), "category_id"),
    ForeignKey("orders_nov", "customer_id", ("customers", "customers_nov"), "customer_id"),
    ForeignKey("orders_nov", "employee_id", ("employees",), "employee_id"),
    ForeignKey("orders_nov", "ship_via", ("shippers",), "shipper_id"),
    ForeignKey("order_details_nov", "order_id", ("orders_nov",), "order_id"),
    ForeignKey("order_details_nov", "product_id", ("products", "products_nov"), "product_id"),
)

COUNTRY_FILE = "world-data-2023.csv"
COUNTRY_COLUMNS = {
    "Country": "country",
    "Abbreviation": "iso_code",
    "Capital/Major City": "capital",
    "Official language": "official_language",
    "Currency-Code": "currency_code",
    "Latitude": "latitude",
    "Longitude": "longitude",
}
SCORE_FILE = "customers_score.csv"
SCORE_COLUMNS = {"customerID": "customer_id", "score": "score"}

# Name used in the warehouse -> name used in the country file.
COUNTRY_ALIASES = {
    "MX": "Mexico",
    "UK": "United Kingdom",
    "USA": "United States",
    "Ireland": "Republic of Ireland",
}
ISO_FALLBACK = {"Ireland": "IE"}

# Versioned attributes of the two history tables.
CUSTOMER_ATTRIBUTES = tuple(
    "company_name contact_name contact_title city region postal_code country phone fax".split()
)
PRODUCT_ATTRIBUTES = tuple(
    "product_name category_id category_name supplier_id supplier_name quantity_per_unit "
    "unit_price units_in_stock units_on_order reorder_level discontinued".split()
)
# ----------------------------------------------------------------------------

_S, _L, _I, _D, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType(),
)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


EVENT_SCHEMA = _schema(
    id=_L, tabla=_S, tipo_evento=_S, nombre_script=_S, fecha_inicio=_TS, fecha_fin=_TS,
    registros_procesados=_L, estado=_S, observaciones=_S,
)
CHECK_SCHEMA = _schema(
    id=_L, tabla=_S, columna=_S, tipo_chequeo=_S, nombre_script=_S, fecha=_TS,
    total_filas_evaluadas=_L, registros_afectados=_L, indicador_calculado=_D,
    umbral_aplicado=_D, resultado=_S, detalle=_S,
)
PROFILE_SCHEMA = _schema(
    id=_L, tabla=_S, columna=_S, nombre_script=_S, fecha=_TS, total_filas=_L, nulos=_L,
    valores_distintos=_L, valor_minimo=_S, valor_maximo=_S, outliers_detectados=_L,
    observaciones=_S,
)
