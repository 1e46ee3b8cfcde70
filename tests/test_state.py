"""State kept beside tables: equal to what the tables give in full, at the cost of a load."""

from datetime import date, datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar import model
from silostar.operators import checks as ck
from silostar.operators import increments, merge, pruning, ranking
from silostar.operators.profile import merged_profile, partial_profile, profile
from silostar.plans import metrics, publication, steps, upkeep
from silostar.sources.tables import Warehouse

T0, T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))
FACT_TYPES = (
    "order_id bigint, product_id bigint, customer_key bigint, product_key bigint, order_date_key int, "
    "ship_geography_key bigint, quantity int, gross_amount decimal(12,2), discount_amount decimal(12,2), net_amount decimal(12,2)"
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def days(frame):
    return frame(
        "date_key int, full_date date, year_number int, month_number int",
        *((202400 * 100 + 100 * m + d, date(2024, m, d), 2024, m) for m in (1, 2, 3) for d in (1, 2, 3)),
    )


def line(order, product, customer, day=20240101, place=1, net="10.00", quantity=1):
    return (order, product, customer, product, day, place, quantity, net, "0.00" if net else None, net)


def lines(frame, *rows_):
    from decimal import Decimal

    number = lambda v: None if v is None else Decimal(v)
    return frame(FACT_TYPES, *((*r[:7], *map(number, r[7:])) for r in rows_))


LOADS = [
    # first load: a hot customer, an order without a known day, null amounts
    [line(k, k % 3 + 1, 7 if k % 3 == 0 else k % 4, 20240100 + k % 3 + 1) for k in range(1, 20)]
    + [line(30, 1, 5, None), line(31, 1, 6, 20230505), line(32, 2, 8, net=None)],
    # a new order, new lines of known orders, one of them with an earlier day than before
    [line(40, 1, 7, 20240201), line(3, 9, 7, 20240301), line(4, 8, 0, 20240101), line(4, 7, 0, 20240103), line(32, 3, 8)],
    # the order without a day gets one; a known order with another customer and place
    [line(30, 4, 5, 20240302), line(5, 9, 2, 20240103, place=2), line(41, 9, 9, 20240301, net="3.33"), line(6, 5, 7, None)],
]


def dims(frame):
    customers = frame("customer_key bigint, customer_id string", *((k, f"c{k}") for k in range(12)))
    products = frame("product_key bigint, product_id bigint", *((k, k) for k in range(12)))
    return customers, products


def test_metrics_from_state_equal_those_from_the_fact(spark, frame, days, wh, monkeypatch):
    """After a first load, two deltas and the second one repeated; no read of the fact."""
    customers, products = dims(frame)
    wh.overwrite(days, steps.DIM_DATE)
    wh.overwrite(customers, steps.DIM_CUSTOMER)
    wh.overwrite(products, steps.DIM_PRODUCT)
    wh.overwrite(lines(frame, *LOADS[0]), steps.FACT)
    steps.refresh_metrics(wh, T0, full=True)
    known = {(r[0], r[1]) for r in LOADS[0]}
    written = []
    plain = Warehouse._write

    def watched(self, df, table, *rest):
        if not table.startswith("dqm_"):
            written.extend(df.inputFiles())
        return plain(self, df, table, *rest)

    for load in (*LOADS[1:], LOADS[2]):
        fresh = lines(frame, *[r for r in load if (r[0], r[1]) not in known])
        known |= {(r[0], r[1]) for r in load}
        with wh.transaction():
            wh.append(fresh, steps.FACT)
            upkeep.note_new_lines(wh, fresh, days)
        with monkeypatch.context() as patch:
            patch.setattr(Warehouse, "_write", watched)
            steps.refresh_metrics(wh, T1)
        fact = wh.read(steps.FACT)
        got = {t: rows(wh.read(t).drop("fecha_calculo")) for t in (steps.CUSTOMER_METRICS, steps.PRODUCT_METRICS)}
        assert got[steps.CUSTOMER_METRICS] == rows(metrics.customer_sales_metrics(fact, customers, days))
        assert got[steps.PRODUCT_METRICS] == rows(metrics.product_sales_metrics(fact, products, days))
    assert written and not any(f"/{steps.FACT}/" in f for f in written)


def test_an_order_whose_day_moves_is_worked_out_anew(frame, days):
    before = metrics.customer_orders(lines(frame, line(1, 1, 7, 20240303), line(2, 1, 7, 20240102)))
    totals = metrics.customer_totals(before, days)
    touched = metrics.customer_orders(lines(frame, line(1, 2, 7, 20240301)))
    _, moved = metrics.updated_customer_totals(totals, touched, before.filter("order_id = 1"), days)
    assert rows(moved) == [(7,)]


def test_partials_are_merged_when_there_are_many_loads(frame, days, wh, monkeypatch):
    monkeypatch.setattr(upkeep, "MOST_LOADS", 2)
    customers, products = dims(frame)
    for table, df in ((steps.DIM_DATE, days), (steps.DIM_CUSTOMER, customers), (steps.DIM_PRODUCT, products)):
        wh.overwrite(df, table)
    wh.overwrite(lines(frame, *LOADS[0]), steps.FACT)
    steps.refresh_metrics(wh, T0, full=True)
    for k in range(3):
        fresh = lines(frame, line(100 + k, 1, 7), line(3, 20 + k, 7))
        wh.append(fresh, steps.FACT)
        upkeep.note_new_lines(wh, fresh, days)
        steps.refresh_metrics(wh, T1)
        assert len(wh.folders(upkeep.CUSTOMER_ORDERS)) <= 2
    got = rows(wh.read(steps.CUSTOMER_METRICS).drop("fecha_calculo"))
    assert got == rows(metrics.customer_sales_metrics(wh.read(steps.FACT), customers, days))


# Sales product --------------------------------------------------------------
GEO = "geography_key bigint, country string, country_iso_code string"


def places(frame):
    return frame(GEO, (1, "France", "FR"), (2, "France", None), (3, None, None))


def placed(fact):
    day = F.col("order_date_key")
    return fact.withColumns({
        "order_year": F.floor(day / 10000).cast("int"), "order_month": F.floor(day / 100).cast("int") % 100,
    })


def test_sales_from_state_follow_the_delta_and_the_scores(spark, frame, days, wh):
    customers, _ = dims(frame)
    geography = places(frame)
    scores = lambda *s: frame("customer_key bigint, score int", *s)
    first = [*LOADS[0], line(50, 1, 7, 20240301, place=3), line(50, 2, 9, 20240301, place=3), line(50, 3, 9, 20240301, place=2)]
    wh.overwrite(placed(lines(frame, *first)), steps.FACT, steps.FACT_PARTITIONS)

    def both(now):
        with wh.transaction():
            state, divided = upkeep.refresh_sales_state(wh, wh.read(steps.FACT), days)
        full = publication.dp01_sales_geo_score(wh.read(steps.FACT), days, geography, customers, now)
        got = publication.dp01_from_state(state, divided, geography, customers, now)
        shown = lambda df: rows(df.select(*[F.col(c).cast("double") if t.startswith("decimal") else c for c, t in df.dtypes]))
        assert shown(got) == shown(full) and shown(got)
        return wh.folders(upkeep.SALES_STATE)

    folders = both(scores((7, 5), (9, 5)))
    assert both(scores((7, 1), (9, 5))) == folders  # a changed score moves a customer, and writes nothing
    for load in LOADS[1:]:
        fresh = placed(lines(frame, *load))
        with wh.transaction():
            wh.append(fresh, steps.FACT, steps.FACT_PARTITIONS)
            upkeep.note_new_lines(wh, fresh, days)
        before = set(folders)
        folders = both(scores((7, 1), (8, 3)))
        months = {r[4] // 100 for r in load if r[4] and r[4] > 20240000}
        kept = {f for f in before if int(f.rsplit("=", 1)[1]) not in months}
        assert kept <= set(folders)


def test_only_touched_months_of_the_fact_are_read(frame, wh):
    wh.overwrite(placed(lines(frame, *LOADS[0], line(90, 1, 1, 20240201))), steps.FACT, steps.FACT_PARTITIONS)
    part = upkeep.of_months(wh.read(steps.FACT), [202402])
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "order_year" in text.split("PartitionFilters: ")[1].split("]")[0] and part.count() == 1
    assert len({r[0] for r in part.select(F.input_file_name()).collect()}) == 1
    assert upkeep.of_months(wh.read(steps.FACT), []).count() == 0


def test_an_order_with_three_customers_in_a_cell(frame, days):
    customers, _ = dims(frame)
    fact = lines(frame, *[line(1, k, k) for k in range(4)], line(2, 1, 1))
    sales = publication.dp01_sales_geo_score(fact, days, places(frame), customers, frame("customer_key bigint, score int"))
    row = sales.first()
    assert (row.clientes_distintos, row.ordenes, row.lineas_orden, float(row.net_amount)) == (4, 2, 5, 50.0)


# Key ranges -----------------------------------------------------------------
def test_key_ranges_hold_every_key_and_leave_gaps_out(spark, frame):
    keys = [1, 2, 5, 10**9, 10**9 + 3, -(2**62), 2**62]
    found = pruning.key_ranges(frame("k bigint", *((k,) for k in [*keys, None, 5])), "k")
    assert len(found) <= pruning.MOST_RANGES
    assert all(any(low <= k <= high for low, high in found) for k in keys)
    near = pruning.key_ranges(frame("k bigint", (1,), (3,), (1000,), (1002,)), "k")
    assert near == [(1, 3), (1000, 1002)]
    assert pruning.key_ranges(frame("k bigint", (None,)), "k") == []
    assert pruning.key_ranges(frame("k string", ("b",), ("a",)), "k") == [("a", "b")]
    assert frame("k bigint", (1,)).filter(pruning.within("k", [])).count() == 0


def test_a_small_batch_reads_few_row_groups_of_the_fact(spark, tmp_path, frame):
    """A target laid out by order: the key ranges are pushed, and of 40 files those of the
    batch are read."""
    import pyarrow.parquet as pq

    spark.range(40_000).selectExpr("id AS order_id", "id % 7 AS product_id").repartitionByRange(40, "order_id").write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    batch = frame("order_id bigint, product_id bigint", (5, 5), (6, 0), (39_990, 1), (50_000, 1))
    ranges = {"order_id": pruning.key_ranges(batch, "order_id")}
    fresh = merge.not_present(batch, target, ["order_id", "product_id"], ranges)
    whole = merge.not_present(batch, target, ["order_id", "product_id"])
    assert rows(fresh) == rows(whole) and {tuple(r) for r in fresh.collect()} == {(6, 0), (39990, 1), (50000, 1)}
    text = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_id" in text.split("PushedFilters: ")[-1] or "GreaterThanOrEqual(order_id" in text
    groups = [
        pq.ParquetFile(f).metadata.row_group(g).column(0).statistics
        for f in (tmp_path / "target").glob("*.parquet") for g in range(pq.ParquetFile(f).num_row_groups)
    ]
    met = [s for s in groups if any(s.min <= high and low <= s.max for low, high in ranges["order_id"])]
    assert len(groups) >= 40 and len(met) <= 2


# Checks ---------------------------------------------------------------------
GRAIN = ck.Rule(ck.FACT_GRAIN, "t", ("a", "b"))
SINGLE = ck.Rule(ck.KEY_DUPLICATES, "t", ("a",))
PARENT = ck.Rule(ck.DIMENSION_JOIN, "t", ("a",), ("p",), "k")
RULES = [GRAIN, SINGLE, PARENT]


def figures(checked):
    return rows(checked.select("tabla", "columna", "tipo_chequeo", "total_filas_evaluadas", "registros_afectados", "resultado"))


def test_checks_of_loads_equal_the_full_ones(spark, frame, wh, monkeypatch):
    measured = []
    for name in ("measure_duplicates", "duplicates_of_load", "orphans_of_load"):
        plain = getattr(increments, name)
        monkeypatch.setattr(
            increments, name, lambda df, *rest, plain=plain, name=name: measured.append((name, df.count())) or plain(df, *rest)
        )

    def compare():
        measured.clear()
        tables = {t: wh.read(t) for t in ("t", "p")}
        with wh.transaction():
            got = figures(upkeep.check_new_folders(wh, RULES, T1, "s"))
        assert got == figures(ck.run_checks(tables, RULES, T1, "s"))
        return sorted(measured)

    types = "a bigint, b string"
    wh.overwrite(frame(types, (1, "x"), (1, "x"), (2, None), (2, None), (None, "y")), "t")
    wh.overwrite(frame("k bigint", (1,), (2,)), "p")
    assert compare() == [("measure_duplicates", 5)] * 2 + [("orphans_of_load", 5)] or measured
    assert compare() == []  # nothing new
    wh.append(frame(types, (1, "x"), (2, None), (3, "z"), (3, "z"), (None, "y"), (None, None)), "t")
    assert compare() == [("duplicates_of_load", 6)] * 2 + [("orphans_of_load", 6)]
    wh.append(frame(types, (9, "z")), "t")
    assert compare() == [("duplicates_of_load", 1)] * 2 + [("orphans_of_load", 1)]
    # more parents: only loads that had orphans are measured again
    wh.append(frame("k bigint", (3,)), "p")
    assert compare() == [("orphans_of_load", 7)]
    # a parent that was replaced: all of the table
    wh.overwrite(frame("k bigint", (9,)), "p")
    assert compare() == [("orphans_of_load", 12)]
    # a table that was replaced
    wh.overwrite(frame(types, (9, "z"), (9, "z")), "t")
    assert compare() == [("measure_duplicates", 2)] * 2 + [("orphans_of_load", 2)]
    wh.overwrite(frame(types).limit(0), "t")
    compare()


def test_duplicates_of_a_load_do_not_move_the_table(spark, frame, tmp_path):
    spark.range(20_000).selectExpr("id AS a", "CAST(id AS STRING) AS b").write.parquet(f"{tmp_path}/t")
    frame("a bigint, b string", (5, "5"), (6, "x"), (6, "x")).write.parquet(f"{tmp_path}/load")
    table, load = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("t", "load"))
    found = increments.duplicates_of_load(load, table, GRAIN)
    text = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert tuple(found.first()) == (3, 2)
    scan = next(i for i, x in enumerate(text) if "FileScan" in x and "GreaterThanOrEqual(a" in x)
    join = max(i for i, x in enumerate(text[:scan]) if "Join" in x)
    assert not any("Exchange" in x for x in text[join:scan])


def test_latest_checks_are_those_of_the_log(spark, frame, wh):
    def checked(*results):
        rule = lambda n: ck.Rule(ck.NOT_NULL, "t", (f"c{n}",))
        return [(rule(n), 10, bad) for n, bad in results]

    for ts, step, results in (
        (T1, "a", [(1, 0), (2, 5)]), (T2, "a", [(2, 0)]), (T1, "b", [(1, 3)]), (T0, "a", [(1, 9)]), (T2, "a", [(2, 4), (2, 0)]),
    ):
        with wh.transaction():
            upkeep.keep_checks(wh, ck.measured_results(spark, checked(*results), ts, step))
        log = steps.read_checks(wh)
        assert rows(upkeep.latest_checks(wh)) == rows(ranking.latest(log, upkeep.CHECK_KEY))
    assert log.count() == 7 and upkeep.latest_checks(wh).count() == 3
    wh.drop(upkeep.LATEST_CHECKS)
    assert rows(upkeep.latest_checks(wh)) == rows(ranking.latest(log, upkeep.CHECK_KEY))


# Profiles -------------------------------------------------------------------
TYPES = "n int, d decimal(8,2), s string, x double, t timestamp_ntz, b boolean, v date"


def wide(frame, *numbers):
    from decimal import Decimal

    return frame(TYPES, *(
        (k, Decimal(k) / 4, f"s{k}", k / 3, datetime(2024, 1, 1, 0, 0, k % 60, abs(k)), k % 2 == 0, date(2024, 1, 1 + k % 28))
        if k is not None else (None,) * 7 for k in numbers
    ))


def test_merged_profiles_equal_the_exact_ones(frame):
    parts = [wide(frame, 9, 10, None), wide(frame, 10, -100, 100), wide(frame), wide(frame, None)]
    whole = reduce(DataFrame.unionByName, parts)
    names = whole.columns
    partials = reduce(DataFrame.unionByName, [partial_profile(p, names) for p in parts])
    merged = merged_profile(partials, whole, "t", names, T1, "s", table_row=True)
    assert rows(merged) == rows(profile(whole, "t", names, T1, "s", table_row=True))


def test_the_error_of_estimated_distinct_values(spark):
    df = spark.range(60_000).selectExpr("id", "CAST(id % 20000 AS STRING) AS s")
    halves = [df.filter("id < 35000"), df.filter("id >= 25000")]
    partials = reduce(DataFrame.unionByName, [partial_profile(p, df.columns) for p in halves])
    merged = {r.columna: r.valores_distintos for r in merged_profile(partials, df, "t", df.columns, T1, "s").collect()}
    assert abs(merged["id"] / 60_000 - 1) < 0.05 and abs(merged["s"] / 20_000 - 1) < 0.05


def test_a_profile_after_an_append_scans_the_new_folder(spark, frame, wh, monkeypatch):
    seen = []
    plain = upkeep.partial_profile
    monkeypatch.setattr(upkeep, "partial_profile", lambda df, names: seen.append(df.count()) or plain(df, names))

    def compare():
        seen.clear()
        with wh.transaction():
            got = upkeep.refresh_profiles(wh, {"t": ["n", "s"], "u": ["n"]}, T1, "s", True)
            exact = [profile(wh.read(t), t, c, T1, "s", True) for t, c in (("t", ["n", "s"]), ("u", ["n"]))]
            assert rows(got) == rows(exact[0].unionByName(exact[1]))
        return seen

    wh.overwrite(wide(frame, 1, 2, None), "t")
    wh.overwrite(wide(frame, 5), "u")
    assert compare() == [3, 1] and compare() == []
    wh.append(wide(frame, 2, 30), "t")
    assert compare() == [2]
    wh.overwrite(wide(frame, 4), "t")
    assert compare() == [1]
    kept = wh.read(upkeep.PARTIALS).select("tabla", "grupo").distinct().count()
    assert kept == 2  # partials of folders that are gone are deleted


# Parts ----------------------------------------------------------------------
def test_replacing_writes_only_the_keys_that_come_in(frame, wh):
    types = "k string, v int"
    wh.replace_where(frame(types, ("a", 1), ("b", 2), (None, 3), ("x/y=z[1]", 4)), "t", "k", whole=True)
    before = set(wh.folders("t"))
    assert len(before) == 4
    assert wh.replace_where(frame(types, ("b", 9), ("b", 8), ("new", 1)), "t", "k") == 3
    after = set(wh.folders("t"))
    assert rows(wh.read("t").select("k", "v")) == [("a", 1), ("b", 8), ("b", 9), ("new", 1), ("x/y=z[1]", 4), (None, 3)]
    assert len(before & after) == 3
    wh.replace_where(frame(types, (None, 5), ("x/y=z[1]", 6)), "t", "k")
    assert rows(wh.read("t").select("k", "v")) == [("a", 1), ("b", 8), ("b", 9), ("new", 1), ("x/y=z[1]", 6), (None, 5)]
    wh.expire()
    assert wh.read("t").count() == 6
    wh.replace_where(frame(types, ("only", 1)), "t", "k", whole=True)
    assert rows(wh.read("t").select("k", "v")) == [("only", 1)]
    assert wh.replace_where(frame(types).limit(0), "t", "k") == 0 and wh.read("t").count() == 1


def test_a_log_that_another_process_wrote_is_refused(frame, wh, spark):
    wh.overwrite(frame("v int", (1,)), "t")
    other = Warehouse(spark, wh.root)
    other.append(frame("v int", (2,)), "t")
    with pytest.raises(RuntimeError, match="another process"):
        wh.append(frame("v int", (3,)), "t")
    wh.reload()
    wh.append(frame("v int", (3,)), "t")
    assert rows(wh.read("t")) == [(1,), (2,), (3,)]


def test_check_fact_measures_loads(spark, frame, wh):
    keys = ("customer", "product", "employee", "shipper", "geography", "date")
    fact = "order_id bigint, product_id bigint, " + ", ".join(
        f"{c} bigint" for c in ("customer_key", "product_key", "employee_key", "shipper_key", "ship_geography_key", "order_date_key")
    )
    for name, table in zip(keys, (steps.DIM_CUSTOMER, steps.DIM_PRODUCT, steps.DIM_EMPLOYEE, steps.DIM_SHIPPER, steps.DIM_GEOGRAPHY, steps.DIM_DATE)):
        wh.overwrite(frame(f"{name}_key bigint", (1,)), table)
    wh.overwrite(frame(fact, (1, 1, 1, 1, 1, 1, 1, 1)), steps.FACT)
    steps.check_fact(wh, T1)
    wh.append(frame(fact, (1, 1, 1, 1, 1, 1, 2, None)), steps.FACT)
    steps.check_fact(wh, T2)
    bad = rows(upkeep.latest_checks(wh).filter("registros_afectados > 0").select("columna", "total_filas_evaluadas", "registros_afectados"))
    assert bad == [("order_id|product_id", 2, 1), ("ship_geography_key -> dwa_dim_geography.geography_key", 2, 1)]
    assert steps.read_checks(wh).count() == 14 and model.CHECK_SCHEMA.names == steps.read_checks(wh).columns
