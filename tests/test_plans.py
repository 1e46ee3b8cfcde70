from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silostar.plans import dashboard, enrichment, metrics, publication, staging, star

D = Decimal


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_to_typed(frame):
    df = frame("i string, d string, t string, z string, blob string",
               ("12", "1.50", "1996-07-04 00:00:00.000", "01581", "0x"), (None, None, None, None, None))
    types = {"i": "int", "d": "decimal(12,4)", "t": "timestamp_ntz", "z": "string"}
    assert rows(staging.to_typed(df, types)) == [
        (12, D("1.5000"), datetime(1996, 7, 4), "01581"), (None, None, None, None),
    ]


@pytest.mark.parametrize("value, to", [("x", "int"), ("", "int"), ("1.23456", "decimal(12,4)"), ("1996-13-01", "timestamp_ntz")])
def test_to_typed_refuses_loss(frame, value, to):
    with pytest.raises(PySparkException, match="cannot become"):
        staging.to_typed(frame("v string", (value,)), {"v": to}).collect()


def orders(frame):
    return frame(
        "order_id int, customer_id string, employee_id int, order_date timestamp_ntz, "
        "required_date timestamp_ntz, shipped_date timestamp_ntz, ship_via int, "
        "freight decimal(12,4), ship_country string, ship_region string, ship_city string, "
        "ship_postal_code string",
        (1, "A", 1, datetime(2024, 1, 1, 9), datetime(2024, 1, 5), None, 1, D(5), "UK", None, " London", "W"),
        (2, "A", 9, datetime(2024, 1, 2), datetime(2024, 1, 5), datetime(2024, 1, 3), 1, D(5), "UK", "", "London ", "W"),
        (3, "Z", 1, datetime(2024, 1, 2), datetime(2024, 1, 5), None, 1, D(5), "UK", None, "London", "W"),
    )


def dims(frame, o):
    customers = frame("country string, region string, city string, postal_code string", ("UK", None, "Leeds", None))
    employees = frame("country string, region string, city string", ("UK", "", "Leeds"))
    geography = star.build_dim_geography(star.source_geo(customers, employees, o))
    return {
        "date": star.build_dim_date(o),
        "geography": geography.withColumn("geography_key", F.col("geography_signature")),
        "customer": frame("customer_id string, customer_key int", ("A", 10)),
        "product": frame("product_id int, product_key int", (1, 100)),
        "employee": frame("employee_id int, employee_key int", (1, 1000)),
        "shipper": frame("shipper_id int, shipper_key int", (1, 1)),
    }


def test_dimensions(frame):
    o = orders(frame)
    d = dims(frame, o)
    assert [r[0] for r in rows(d["date"].select("full_date"))] == [date(2024, 1, n) for n in (1, 2, 3, 5)]
    geography = {r.geography_signature: r.city for r in d["geography"].collect()}
    # two spellings are one place, and customer and employee share one
    assert geography == {"UK|<none>|London|W": " London", "UK|<none>|Leeds|<none>": "Leeds"}
    new = orders(frame).withColumn("ship_city", F.lit("York"))
    assert [r.city for r in star.extend_dim_geography(d["geography"], new).collect()] == ["York"]
    assert star.extend_dim_date(d["date"], o).count() == 0


def lines(frame):
    return frame(
        "order_id int, product_id int, unit_price decimal(12,4), quantity int, discount decimal(8,6)",
        (1, 1, D("10.0"), 2, None), (2, 1, D("10.0"), 1, D("0.1")), (1, 7, D(1), 1, D(0)),
        (3, 1, D(1), 1, D(0)),
    )


def test_fact(frame):
    o = orders(frame)
    d = dims(frame, o)
    shown = ["order_id", "customer_key", "employee_key", "order_date_key", "shipped_date_key", "discount", "net_amount"]
    # order 2 has an unknown employee, order 3 an unknown customer, product 7 is unknown
    strict = star.build_fact(lines(frame), o, d, "strict").select(*shown)
    assert rows(strict) == [(1, 10, 1000, 20240101, None, D(0), D(20))]
    lenient = star.build_fact(lines(frame), o, d, "lenient").select(*shown)
    assert rows(lenient) == [
        (1, 10, 1000, 20240101, None, None, None),
        (2, 10, None, 20240102, 20240103, D("0.1"), D("9")),
    ]
    dropped = star.dropped_lines(lines(frame), o, d["customer"], d["product"])
    assert rows(dropped.select("order_id", "product_id")) == [(1, 7), (3, 1)]


FACT = (
    "order_id int, customer_key int, product_key int, ship_geography_key int, order_date_key int, "
    "quantity int, gross_amount decimal(12,2), discount_amount decimal(12,2), net_amount decimal(12,2)"
)


def fact(frame):
    return frame(
        FACT,
        (1, 1, 1, 1, 20240101, 2, D(20), D(0), D(20)),
        (1, 1, 2, 1, 20240101, 1, D(10), D(1), D(9)),
        (2, 1, 1, 1, 20240105, 1, D(10), D(0), D(10)),
        (3, 2, 1, 2, None, 1, D(5), D(0), D(5)),
        (1, 2, 1, 1, 20240101, 1, D(1), D(0), D(1)),  # one order under two customers
    )


def days(frame):
    return star.build_dim_date(
        frame("d timestamp_ntz", (datetime(2024, 1, 1),), (datetime(2024, 1, 5),)), ["d"]
    )


def test_metrics(frame):
    customers = frame("customer_key int, customer_id string", (1, "A"), (2, "B"), (3, "C"))
    got = metrics.customer_sales_metrics(fact(frame), customers, days(frame)).select(
        "customer_id", "order_count", "order_line_count", "total_quantity", "net_amount",
        "avg_order_net_amount", "first_order_date", "last_order_date",
    )
    one, five = date(2024, 1, 1), date(2024, 1, 5)
    # B's order without a day keeps its line but is no order; C has no sales
    assert rows(got) == [
        ("A", 2, 3, 4, D("39.00"), 19.5, one, five), ("B", 1, 2, 2, D("6.00"), 1.0, one, one),
    ]
    products = frame("product_key int, product_id string", (1, "p"), (2, "q"))
    got = metrics.product_sales_metrics(fact(frame), products, days(frame)).select(
        "product_id", "order_count", "order_line_count", "avg_line_net_amount"
    )
    assert rows(got) == [("p", 2, 3, 31 / 3), ("q", 1, 1, 9.0)]


def test_dp01(frame):
    geography = frame(
        "geography_key int, country string, country_iso_code string",
        (1, "UK", None), (2, None, None), (3, "UK", "GB"),
    )
    customers = frame("customer_key int", (1,), (2,))
    scores = frame("customer_key int, score int", (1, 4))
    later = fact(frame).unionByName(frame(FACT, (9, 2, 1, 2, 20240105, 1, D(7), D(0), D(7))))
    got = publication.dp01_sales_geo_score(later, days(frame), geography, customers, scores)
    shown = got.select(
        "periodo", "ship_country", "country_iso_code", "score_segment", "score_segment_order",
        "clientes_distintos", "ordenes", "lineas_orden", "cantidad_total", "net_amount",
        "avg_order_net_amount",
    )
    # a place that is not enriched does not split the cell of its country
    assert rows(shown) == [
        ("2024-01", "<sin_pais>", None, "sin_score", 4, 1, 1, 1, 1, D(7), 7.0),
        ("2024-01", "UK", "GB", "alto_4_5", 1, 1, 2, 3, 4, D(39), 19.5),
        ("2024-01", "UK", "GB", "sin_score", 4, 1, 1, 1, 1, D(1), 1.0),
    ]


def test_order_in_one_cell_under_two_customers_counts_once(frame):
    geography = frame("geography_key int, country string", (1, "UK"))
    customers = frame("customer_key int", (1,), (2,))
    scores = frame("customer_key int, score int").limit(0)
    shared = fact(frame).filter("order_id = 1")
    row = publication.dp01_sales_geo_score(shared, days(frame), geography, customers, scores).first()
    assert (row.clientes_distintos, row.ordenes, row.lineas_orden) == (2, 1, 3)


COUNTRIES = (
    "country string, iso_code string, capital string, official_language string, "
    "currency_code string, latitude string, longitude string"
)


def test_enrich_geography(frame):
    countries = frame(
        COUNTRIES,
        ("Mexico", "MX", "Mexico City", "Spanish", "MXN", "23.6", "-102.5"),
        ("Republic of Ireland", "", "Dublin", " ", "EUR", None, None),
        ("Ireland", "XX", "other", "other", "other", "1", "1"),
        ("France", "FR", "Paris", "French", "EUR", "46.2", "2.2"),
    )
    geography = frame(
        "geography_key int, country string, country_capital string",
        (1, "MX", None), (2, "Mexico", "old"), (3, "Ireland", None), (4, "Nowhere", "kept"), (5, None, None),
    )
    got = enrichment.enrich_geography(geography, countries).select(
        "geography_key", "country_iso_code", "country_capital", "country_language", "country_latitude"
    )
    assert rows(got) == [
        (1, "MX", "Mexico City", "Spanish", 23.6),
        (2, "MX", "Mexico City", "Spanish", 23.6),  # the alias target under its own name too
        (3, "IE", "Dublin", None, None),  # alias before a record of the same name; fallback code
        (4, None, "kept", None, None),
        (5, None, None, None, None),
    ]
    again = enrichment.enrich_geography(enrichment.enrich_geography(geography, countries), countries)
    assert rows(again) == rows(enrichment.enrich_geography(geography, countries))


def test_bad_coordinate_raises(spark, frame):
    countries = frame(COUNTRIES, ("France", "FR", "Paris", "French", "EUR", "north", "2.2"))
    geography = frame("geography_key int, country string", (1, "France"))
    with pytest.raises(PySparkException):
        enrichment.enrich_geography(geography, countries).collect()


def test_scores(frame):
    scores = frame("customer_id string, score string", ("A", "1"), ("A", "5"), ("B", ""), ("X", "3"), ("C", None))
    customers = frame("customer_key int, customer_id string", (1, "A"), (2, "B"), (3, "C"))
    best = enrichment.best_scores(scores, customers)
    assert rows(best) == [(1, "A", 5)]
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    target = frame("customer_key int, customer_id string, score int, fecha_carga timestamp_ntz",
                   (1, "A", 2, t1), (2, "B", 3, t1))
    assert rows(enrichment.load_scores(target, best, t2)) == [(1, "A", 5, t2), (2, "B", 3, t1)]


def test_dp02_and_reports(frame):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    log = frame(
        "nombre_script string, tabla string, columna string, tipo_chequeo string, resultado string, "
        "registros_afectados bigint, indicador_calculado double, umbral_aplicado double, fecha timestamp_ntz",
        ("s", "t", None, "C", "OK", 0, 0.0, 0.0, t1),
        ("s", "t", None, "C", "OK", None, 0.5, 0.0, t2),
        ("r", "t", "a", "C", "ERROR", 3, 1.0, 0.0, t1),
    )
    summary = publication.dp02_checks(log)
    assert rows(summary) == [
        ("r", "t", "a", "C", "ERROR", 1, 3, 1.0, 0.0, t1), ("s", "t", None, "C", "OK", 2, 0, 0.5, 0.0, t2),
    ]
    assert rows(publication.dp02_step_checks(log, "s").select("checks")) == [(1,)]
    assert [r.resultado for r in dashboard.check_status(summary).collect()] == ["ERROR", "OK"]
    assert [r.nombre_script for r in dashboard.recent_checks(summary, 1).collect()] == ["s"]

    profiles = frame(
        "tabla string, columna string, total_filas bigint, nulos bigint, valores_distintos bigint, "
        "outliers_detectados bigint, fecha timestamp_ntz",
        ("t", None, 5, None, None, 0, t1), ("t", "a", 5, 1, 2, 0, t1), ("u", "b", None, 0, 0, 0, t1),
    )
    summary = publication.dp02_profiles_or_default(profiles, F.lit(None).cast("timestamp_ntz"))
    assert rows(summary) == [("t", 1, 5, 1, 2, 0, t1), ("u", 1, None, 0, 0, 0, t1)]
    assert [r.tabla for r in dashboard.top_profiles(summary).collect()] == ["t", "u"]
    empty = publication.dp02_profiles_or_default(profiles.limit(0), F.lit(t2).cast("timestamp_ntz"))
    assert rows(empty) == [("sin_perfilado_disponible", 0, 0, 0, 0, 0, t2)]


def test_bar_width(frame):
    df = frame("v decimal(12,2)", (D(200),), (D(199),), (D(1),), (None,), (D(-50),))
    assert [r.width for r in dashboard.bar_width(df, "v").collect()] == [100, 99, 2, 2, 2]
    zero = frame("v decimal(12,2)", (D(0),))
    assert [r.width for r in dashboard.bar_width(zero, "v").collect()] == [2]
