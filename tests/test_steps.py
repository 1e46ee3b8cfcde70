"""Files to products: a small first load, a delta, the same delta again, publication."""

import csv
from datetime import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from silostar import model
from silostar.plans import steps
from silostar.sources.tables import Warehouse

T0, T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))


def write(folder, source, rows):
    """A file with the declared columns; columns not given hold the text NULL."""
    with open(folder / source.file, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, delimiter=source.separator)
        out.writerow([c.replace("_", "") for c in source.columns])
        for row in rows:
            out.writerow([row.get(c, "NULL") for c in source.columns])


def ts(day):
    return f"{day} 00:00:00.000"


def customer(key, name, city="Lyon", country="France"):
    return {"customer_id": key, "company_name": name, "city": city, "country": country}


def product(key, name, stock="10"):
    return {
        "product_id": key, "product_name": name, "supplier_id": "1", "category_id": "1",
        "quantity_per_unit": "1 box", "unit_price": "10.5", "units_in_stock": stock,
        "units_on_order": "0", "reorder_level": "5", "discontinued": "0",
    }


def order(key, who, day, country="France", city="Lyon"):
    return {
        "order_id": key, "customer_id": who, "employee_id": "1", "order_date": ts(day),
        "required_date": ts("1998-02-01"), "ship_via": "1", "freight": "3.25",
        "ship_country": country, "ship_city": city,
    }


def line(order_id, product_id, quantity="2", discount="0"):
    return {
        "order_id": order_id, "product_id": product_id, "unit_price": "10.5",
        "quantity": quantity, "discount": discount,
    }


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    write(folder, model.CATEGORIES, [{"category_id": "1", "category_name": "Drinks", "picture": "0x15"}])
    write(folder, model.SUPPLIERS, [{"supplier_id": "1", "company_name": "Supply, Inc"}])
    write(folder, model.SHIPPERS, [{"shipper_id": "1", "company_name": "Speedy"}])
    write(folder, model.REGIONS, [{"region_id": "1", "region_description": "East"}])
    write(folder, model.CUSTOMERS, [customer("AAA", "A"), customer("BBB", "B", "Cork", "Ireland"), customer("CCC", "C")])
    write(folder, model.EMPLOYEES, [
        {"employee_id": "1", "last_name": "Paz", "first_name": "Ana", "country": "UK", "birth_date": ts("1960-01-01")},
        {"employee_id": "2", "last_name": "Gil", "first_name": "Luz", "country": "UK", "reports_to": "1"},
    ])
    write(folder, model.PRODUCTS, [product("1", "Tea"), product("2", "Milk", "0")])
    write(folder, model.TERRITORIES, [{"territory_id": "01581", "territory_description": "West", "region_id": "1"}])
    write(folder, model.EMPLOYEE_TERRITORIES, [{"employee_id": "1", "territory_id": "01581"}])
    write(folder, model.ORDERS, [
        order("10", "AAA", "1998-01-05"),
        order("11", "BBB", "1998-01-06", "Ireland", "Cork") | {"shipped_date": ts("1998-01-09")},
    ])
    write(folder, model.ORDER_DETAILS, [line("10", "1"), line("10", "2", "1", "0.1"), line("11", "1", "4")])

    write(folder, model.CUSTOMERS_DELTA, [customer("AAA", "A new", "Nice"), customer("CCC", "C"), customer("DDD", "D", "York", "UK")])
    write(folder, model.PRODUCTS_DELTA, [product("1", "Tea", "3"), product("3", "Rice"), product("2", "Milk", "0")])
    write(folder, model.ORDERS_DELTA, [
        order("12", "DDD", "1998-02-03", "UK", "York"), order("10", "AAA", "1998-01-05"),
        order("13", "AAA", "1998-02-04"),
    ])
    write(folder, model.ORDER_DETAILS_DELTA, [
        line("12", "3"), line("10", "1", "9"), line("13", "1"), line("13", "2"),
    ])
    (folder / model.COUNTRY_FILE).write_text(
        "Country,Abbreviation,Capital/Major City,Official language,Currency-Code,Latitude,Longitude\n"
        "France,FR,Paris,French,EUR,46.2,2.2\nRepublic of Ireland,,Dublin,English,EUR,53.4,-8.2\n"
        "United Kingdom,GB,London,English,GBP,55.4,-3.4\n"
    )
    (folder / model.SCORE_FILE).write_text("customerID;score\nAAA;2\nAAA;5\nBBB;\nDDD;1\n")
    return str(folder)


@pytest.fixture(scope="module")
def loaded(spark, files, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    rows = steps.initial_load(wh, files, T0, approx_profiles=True)
    return wh, rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_initial_load(loaded):
    wh, written = loaded
    assert written[steps.FACT] == 3
    assert written[steps.DIM_CUSTOMER] == 3 and written[steps.DIM_EMPLOYEE] == 2
    checks = steps.read_checks(wh)
    assert checks.filter("resultado = 'ERROR'").isEmpty()
    # 19 + 44 on raw text, 11 keys, 16 before the load, 1 count
    assert checks.count() == 91
    assert checks.select("id").distinct().count() == 91
    fact = wh.read(steps.FACT)
    assert fact.select("order_line_key").distinct().count() == 3
    assert rows(wh.read(steps.DIM_PRODUCT).select("product_key")) == [(1,), (2,)]
    names = dict(rows(wh.read(steps.DIM_CUSTOMER).select("customer_key", "customer_id")))
    got = {(names[r.customer_key], float(r.net_amount)) for r in fact.collect()}
    assert got == {("AAA", 21.0), ("AAA", 9.45), ("BBB", 42.0)}
    products = rows(wh.read(steps.DIM_PRODUCT).select("product_id", "supplier_name", "stock_alarm_level"))
    assert products == [(1, "Supply, Inc", 0), (2, "Supply, Inc", 2)]
    metrics = rows(wh.read(steps.CUSTOMER_METRICS).select("customer_id", "order_count", "net_amount"))
    assert [(c, n, float(a)) for c, n, a in metrics] == [("AAA", 1, 30.45), ("BBB", 1, 42.0)]
    events = wh.read(steps.EVENTS, model.EVENT_SCHEMA)
    kinds = dict(rows(events.groupBy("tipo_evento").count()))
    assert kinds == {"CARGA_TXT": 11, "CARGA_TMP": 11, "CARGA_DWA": 11}
    assert rows(wh.read("tmp_territories").select("territory_id")) == [("01581",)]
    assert "picture" not in wh.read("tmp_categories").columns


def test_loading_twice_is_refused(loaded):
    wh, _ = loaded
    with pytest.raises(RuntimeError, match="already holds rows"):
        steps.stage(wh, model.INITIAL)
    with pytest.raises(RuntimeError, match="already holds rows"):
        steps.load_warehouse(wh, T0)


def test_delta_enrichment_and_publication(loaded, files):
    wh, _ = loaded
    summary = steps.delta_load(wh, files, T1, approx_profiles=True)
    # 12 and 13 are new; line (10, 1) is known and ignored
    assert summary.pop("total_segundos") > 0
    assert summary == {
        "fechas_nuevas": 2, "geografias_nuevas": 2, "clientes_modificados": 2,
        "productos_modificados": 2, "lineas_descartadas": 0, "lineas_hecho_nuevas": 3,
    }
    fact = wh.read(steps.FACT)
    assert fact.count() == 6 and fact.select("order_line_key").distinct().count() == 6
    assert fact.groupBy("order_id", "product_id").count().filter("count > 1").isEmpty()

    versions = rows(
        wh.read(steps.CUSTOMER_HISTORY).select("customer_id", "company_name", "es_vigente", "vigente_hasta")
    )
    assert versions == [
        ("AAA", "A new", 1, None), ("AAA", "A", 0, T1), ("BBB", "B", 1, None),
        ("CCC", "C", 1, None), ("DDD", "D", 1, None),
    ]
    dim = wh.read(steps.DIM_CUSTOMER).join(
        wh.read(steps.DIM_GEOGRAPHY).select(F.col("geography_key").alias("customer_geography_key"), F.col("city").alias("place")),
        "customer_geography_key",
    )
    # a changed customer moves to the new place, a new one gets a row
    assert rows(dim.select("customer_id", "company_name", "place")) == [
        ("AAA", "A new", "Nice"), ("BBB", "B", "Cork"), ("CCC", "C", "Lyon"), ("DDD", "D", "York"),
    ]
    stock = rows(wh.read(steps.DIM_PRODUCT).select("product_id", "units_in_stock", "stock_alarm_level"))
    assert stock == [(1, 3, 1), (2, 0, 2), (3, 10, 0)]
    net = rows(wh.read(steps.CUSTOMER_METRICS).select("customer_id", "order_count"))
    assert net == [("AAA", 2), ("BBB", 1), ("DDD", 1)]

    changed = rows(wh.read(steps.CHANGES).select("fecha", "entidad", "clave"))
    assert changed == [(T1, "customer", "AAA"), (T1, "customer", "DDD"), (T1, "product", "1"), (T1, "product", "3")]
    metrics = {t: rows(wh.read(t).drop("fecha_calculo")) for t in (steps.CUSTOMER_METRICS, steps.PRODUCT_METRICS)}
    steps.refresh_metrics(wh, T1, full=True)
    assert metrics == {t: rows(wh.read(t).drop("fecha_calculo")) for t in metrics}

    closed = wh.folders(steps.CUSTOMER_HISTORY, steps.CLOSED)
    again = steps.delta_load(wh, files, T2, approx_profiles=True)
    assert wh.folders(steps.CUSTOMER_HISTORY, steps.CLOSED)[: len(closed)] == closed
    del again["total_segundos"]
    assert set(again.values()) == {0}
    assert wh.read(steps.FACT).count() == 6 and len(versions) == wh.read(steps.CUSTOMER_HISTORY).count()

    steps.integrate_countries(wh, files)
    steps.integrate_scores(wh, files, T2)
    places = dict(rows(wh.read(steps.DIM_GEOGRAPHY).select("country", "country_iso_code").distinct()))
    assert places == {"France": "FR", "Ireland": "IE", "UK": "GB"}
    assert rows(wh.read(steps.SCORES).select("customer_id", "score")) == [("AAA", 5), ("DDD", 1)]

    steps.publish(wh, T3)
    steps.check_published(wh, T3)
    sales = wh.read(steps.SALES)
    cells = rows(sales.select("periodo", "ship_country", "score_segment", "ordenes", "net_amount"))
    assert [(p, c, s, n, float(a)) for p, c, s, n, a in cells] == [
        ("1998-01", "France", "alto_4_5", 1, 30.45), ("1998-01", "Ireland", "sin_score", 1, 42.0),
        ("1998-02", "France", "alto_4_5", 1, 42.0), ("1998-02", "UK", "bajo_0_1", 1, 21.0),
    ]
    assert float(sales.agg(F.sum("net_amount")).first()[0]) == float(
        wh.read(steps.FACT).agg(F.sum("net_amount")).first()[0]
    )
    own = wh.read(steps.CHECK_SUMMARY).filter("nombre_script = 'check_published'")
    assert own.agg(F.sum("checks")).first()[0] == 6
    assert steps.read_checks(wh).filter("resultado = 'ERROR'").isEmpty()
    assert wh.read(steps.CHECK_SUMMARY).filter("nombre_script = 'check_raw'").count() == 63

    reports = steps.dashboards(wh)
    kpis = reports["kpis"].first()
    assert (kpis.filas_dp, kpis.paises, kpis.ordenes) == (4, 3, 4)
    assert [r.width for r in reports["top_countries"].collect()] == [100, 57, 28]
    assert len(reports["top_profiles"].collect()) == 15


def test_bad_raw_text_stops_the_load(spark, files, tmp_path):
    broken = tmp_path / "broken"
    broken.mkdir()
    write(broken, model.REGIONS, [{"region_id": "x", "region_description": "East"}, {"region_id": "2"}])
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    steps.acquire(wh, str(broken), [model.REGIONS])
    with pytest.raises(RuntimeError, match="never checked"):
        steps.stage(wh, [model.REGIONS])
    steps.check_raw(wh, [model.REGIONS], T0)
    with pytest.raises(RuntimeError, match="NOT_NULL.*FORMATO_ENTERO"):
        steps.stage(wh, [model.REGIONS])
    # corrected and checked again: the old errors no longer block
    write(broken, model.REGIONS, [{"region_id": "1", "region_description": "East"}])
    steps.acquire(wh, str(broken), [model.REGIONS])
    steps.check_raw(wh, [model.REGIONS], T1)
    assert steps.stage(wh, [model.REGIONS]) == {"tmp_regions": 1}


def test_orphans_stop_the_delta(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.overwrite(frame("order_id int, k string", (1, "XXXXX")), "tmp_orders_nov")
    wh.overwrite(frame("customer_id string", ("AAA",)), "tmp_customers")
    key = model.ForeignKey("orders_nov", "k", ("customers",), "customer_id")
    steps.check_keys(wh, [key], T0, "check_delta_keys")
    from silostar.operators import gates

    with pytest.raises(RuntimeError, match="FK_INTEGRIDAD"):
        gates.gate_tables(steps.read_checks(wh), ["tmp_orders_nov"], ["check_delta_keys"])


def test_snapshots(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    assert not wh.exists("t")
    with pytest.raises(LookupError):
        wh.read("t")
    assert wh.overwrite(frame("k string, v int", ("a", 1), ("b", 2)), "t", ["k"]) == 2
    assert wh.append(frame("k string, v int", ("b", 3)), "t", ["k"]) == 1
    assert rows(wh.read("t").select("k", "v")) == [("a", 1), ("b", 2), ("b", 3)]
    # only the partition of the key that comes in is replaced
    assert wh.replace_where(frame("k string, v int", ("b", 9)), "t", "k") == 1
    assert rows(wh.read("t").select("k", "v")) == [("a", 1), ("b", 9)]
    # a table may be rewritten from its own content, and older readers keep theirs
    old = wh.read("t")
    assert wh.overwrite(old.filter("v < 9"), "t") == 1
    assert rows(wh.read("t").select("k", "v")) == [("a", 1)]
    assert old.count() == 2
    # expiry leaves the current content
    assert wh.expire() == 3
    assert rows(wh.read("t").select("k", "v")) == [("a", 1)]
    # another process finds the current content through the log
    assert rows(Warehouse(spark, wh.root).read("t").select("k", "v")) == [("a", 1)]


def test_partition_values_keep_their_type(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.overwrite(frame("step string, v int", ("007", 1)), "t", ["step"])
    wh.append(frame("v int, step string, more string", (2, "8", "x")), "t", ["step"])
    assert rows(wh.read("t")) == [("007", 1, None), ("8", 2, "x")]


def test_drop_lets_a_table_be_loaded_anew(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.overwrite(frame("k bigint", (5,)), "t", key="k")
    wh.drop("t")
    assert not wh.exists("t") and wh.highest("t") == 5
    wh.append(frame("k bigint", (6,)), "t", key="k")
    assert rows(Warehouse(spark, wh.root).read("t")) == [(6,)] and wh.version("t") == 3


def test_a_transaction_is_published_whole_or_not_at_all(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.overwrite(frame("v int", (1,)), "a")
    with pytest.raises(ZeroDivisionError), wh.transaction():
        wh.append(frame("v int", (2,)), "a")
        wh.overwrite(frame("v int", (3,)), "b")
        assert rows(wh.read("a")) == [(1,), (2,)] and rows(wh.read("b")) == [(3,)]
        1 / 0
    for seen in (wh, Warehouse(spark, wh.root)):
        assert rows(seen.read("a")) == [(1,)] and not seen.exists("b")
    with wh.transaction():
        wh.append(frame("v int", (2,)), "a")
        wh.overwrite(frame("v int", (3,)), "b")
    assert rows(Warehouse(spark, wh.root).read("a")) == [(1,), (2,)]


def test_an_unreadable_log_is_no_empty_warehouse(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.overwrite(frame("v int", (1,)), "a")
    for file in (tmp_path / "warehouse" / "_snapshots").glob("part-*"):
        file.write_bytes(b"no parquet")
    with pytest.raises(Exception) as error:
        Warehouse(spark, wh.root).exists("a")
    assert "PATH_NOT_FOUND" not in str(error.value)


def test_data_replaced_after_its_checks_is_refused(spark, files, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    write(folder, model.REGIONS, [{"region_id": "1", "region_description": "East"}])
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    steps.acquire(wh, str(folder), [model.REGIONS])
    steps.check_raw(wh, [model.REGIONS], T0)
    write(folder, model.REGIONS, [{"region_id": "1"}, {"region_id": "1"}])
    steps.acquire(wh, str(folder), [model.REGIONS])
    with pytest.raises(RuntimeError, match="changed since check_raw: txt_regions"):
        steps.stage(wh, [model.REGIONS])


class Broken(Exception):
    pass


def break_writes(monkeypatch, wh, table):
    """The write of one table fails. What comes before it is empty, which is faster: nothing
    of it may be seen anyway."""
    plain = type(wh)._write

    def write_or_fail(self, df, name, *rest):
        if name == table:
            raise Broken(name)
        return plain(self, df.limit(0), name, *rest)

    monkeypatch.setattr(type(wh), "_write", write_or_fail)


def content(wh):
    """All tables but for times, and for numbers of keys whose order is free."""
    return {
        t: rows(wh.read(t).select(*[c for c in wh.read(t).columns if not c.startswith("fecha_")]))
        for t in sorted(wh._snapshots()) if wh.exists(t) and not t.startswith("dqm_")
    }


@pytest.mark.parametrize("step", ["load_warehouse", "update_warehouse"])
def test_a_broken_step_changes_nothing_and_runs_again(spark, files, tmp_path, monkeypatch, step):
    def prepared(name):
        wh = Warehouse(spark, str(tmp_path / name))
        run = partial(steps.load_warehouse, wh, T0)
        steps.acquire(wh, files, model.INITIAL)
        steps.check_raw(wh, model.INITIAL, T0)
        steps.stage(wh, model.INITIAL)
        steps.check_keys(wh, model.INITIAL_KEYS, T0)
        steps.check_staged(wh, T0)
        if step == "update_warehouse":
            run()
            steps.acquire(wh, files, model.DELTA, "acquire_delta")
            steps.check_raw(wh, model.DELTA, T1, "check_delta")
            steps.stage(wh, model.DELTA, "stage_delta", "check_delta")
            steps.check_keys(wh, model.DELTA_KEYS, T1, "check_delta_keys")
            run = partial(steps.update_warehouse, wh, T1)
        return wh, run

    whole, run = prepared("whole")
    before = {t: whole.version(t) for t in whole._snapshots()}
    expected = run()
    written = sorted(t for t in whole._snapshots() if whole.version(t) != before.get(t, 0))
    assert len(written) >= 10

    wh, run = prepared("broken")
    before = content(wh)
    for table in written:
        with monkeypatch.context() as patch:
            break_writes(patch, wh, table)
            with pytest.raises(Broken):
                run()
        assert {t for t in wh._snapshots() if wh.exists(t)} == set(before) | {
            t for t in wh._snapshots() if t.startswith("dqm_")
        }
    assert content(Warehouse(spark, wh.root)) == before
    summary = run()
    summary.pop("total_segundos", None), expected.pop("total_segundos", None)
    assert summary == expected and content(wh) == content(whole)
