from datetime import datetime

import pytest

from silostar import model
from silostar.operators import checks as ck
from silostar.operators import gates
from silostar.operators.profile import profile

TS = datetime(2024, 1, 1)
LOG = (
    "id bigint, tabla string, columna string, tipo_chequeo string, nombre_script string, "
    "fecha timestamp_ntz, resultado string, detalle string"
)


def run(tables, *rules):
    rows = ck.run_checks(tables, rules, TS, "s").collect()
    return [(r.total_filas_evaluadas, r.registros_afectados, r.resultado) for r in rows]


def test_declared_rule_counts():
    def count(sources):
        return sum(len(ck.raw_rules(s)) for s in sources)

    assert count(model.INDEPENDENT) == 19
    assert count(model.DEPENDENT) == 44
    # 27, plus two date formats and the key of the details (two columns, duplicates)
    assert count(model.DELTA) == 32
    assert len(ck.foreign_key_rules(model.INITIAL_KEYS)) == 11
    assert len(ck.foreign_key_rules(model.DELTA_KEYS)) == 7
    assert len(ck.warehouse_rules()) + 1 == 16
    assert len(ck.sales_rules()) + 2 == 6


def test_formats(frame):
    df = frame("v string", ("12",), ("-1",), ("",), ("12\n",), ("1.",), ("1.5",), (None,))
    assert run({"t": df}, ck.Rule(ck.INTEGER_FORMAT, "t", ("v",))) == [(7, 5, "ERROR")]
    assert run({"t": df}, ck.Rule(ck.NUMERIC_FORMAT, "t", ("v",))) == [(7, 4, "ERROR")]


def test_keys(frame):
    df = frame("a int, b int", (1, 1), (1, 1), (None, 1), (None, 1), (2, None), (2, None), (3, 3))
    assert run({"t": df}, ck.Rule(ck.KEY_NULLS, "t", ("a",))) == [(7, 2, "ERROR")]
    assert run({"t": df}, ck.Rule(ck.KEY_DUPLICATES, "t", ("a",))) == [(5, 2, "ERROR")]
    # null is a value in a composite key
    assert run({"t": df}, ck.Rule(ck.KEY_DUPLICATES, "t", ("a", "b"))) == [(7, 3, "ERROR")]
    assert run({"t": df.limit(0)}, ck.Rule(ck.FACT_GRAIN, "t", ("a", "b"))) == [(0, 0, "OK")]


def test_foreign_key(frame):
    child = frame("k int", (1,), (2,), (2,), (9,), (9,), (9,), (None,))
    parent = frame("k int", (1,), (2,), (2,), (None,))
    rule = ck.Rule(ck.FOREIGN_KEY, "c", ("k",), ("p",), "k")
    # a null or repeated parent key changes neither the orphans nor the total
    assert run({"c": child, "p": parent}, rule) == [(7, 3, "ERROR")]
    text = parent.selectExpr("cast(k as string) as k")
    assert run({"c": child, "p": text}, rule) == [(7, 3, "ERROR")]


def test_foreign_key_to_either_parent_and_to_itself(frame):
    child = frame("id int, k int", (1, None), (2, 1), (3, 7))
    more = frame("k int, id int", (0, 7))
    either = ck.Rule(ck.FOREIGN_KEY, "c", ("k",), ("c", "m"), "id")
    assert run({"c": child, "m": more}, either) == [(3, 0, "OK")]
    itself = ck.Rule(ck.FOREIGN_KEY, "c", ("k",), ("c",), "id")
    assert run({"c": child}, itself) == [(3, 1, "ERROR")]


def test_measures_stock_text(frame):
    lines = frame(
        "p double, q int, d double",
        (1.0, 1, 0.0), (-1.0, 1, 1.0), (None, 1, 0.0), (1.0, 0, 0.0), (1.0, 1, 1.1), (1.0, 1, -0.1), (1.0, 1, None),
    )
    assert run({"t": lines}, ck.Rule(ck.VALID_MEASURE, "t", ("p", "q", "d"))) == [(7, 5, "ERROR")]
    stock = frame("a int, b int, c int", (0, 0, 0), (None, 0, 0), (1, -1, 0), (1, 1, None))
    assert run({"t": stock}, ck.Rule(ck.VALID_STOCK, "t", ("a", "b", "c"))) == [(4, 3, "ERROR")]
    text = frame("v string", ("x",), ("",), ("  ",), (None,))
    assert run({"t": text}, ck.Rule(ck.REQUIRED_PLACE, "t", ("v",))) == [(4, 3, "ERROR")]


def test_one_scan_per_table(frame):
    df = frame("a int, b string", (1, "x"), (None, "y"))
    rules = [
        ck.Rule(ck.SOURCE_NOT_EMPTY, "t"),
        ck.Rule(ck.NOT_NULL, "t", ("a",)),
        ck.Rule(ck.INTEGER_FORMAT, "t", ("b",)),
    ]
    checked = ck.run_checks({"t": df}, rules, TS, "s")
    assert len(checked.collect()) == 3
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    with pytest.raises(ValueError):
        ck.run_checks({"t": df}, [ck.Rule("OTHER", "t", ("a",))], TS, "s")


def test_indicator_of_empty_table(frame):
    df = frame("a int")
    row = ck.run_checks({"t": df}, [ck.Rule(ck.NOT_NULL, "t", ("a",))], TS, "s").first()
    assert (row.total_filas_evaluadas, row.indicador_calculado, row.resultado) == (0, 0.0, "OK")


def test_tables_not_empty_and_reconciliation(frame):
    full, none = frame("a int", (1,), (2,)), frame("a int")
    row = ck.tables_not_empty({"x": full, "y": none, "z": none}, "l", TS, "s").first()
    assert (row.total_filas_evaluadas, row.registros_afectados) == (3, 2)
    row = ck.row_reconciliation(none, full, "f", TS, "s").first()
    assert (row.total_filas_evaluadas, row.registros_afectados, row.resultado) == (2, 2, "ERROR")


def day(n):
    return datetime(2024, 1, n)


def log(frame, *rows):
    return frame(LOG, *[(i, t, c, "NOT_NULL", s, day(d), r, "x") for i, t, c, s, d, r in rows])


def test_latest_result_counts(frame):
    fixed = log(
        frame,
        (1, "t", "a", "raw", 1, "ERROR"),
        (2, "t", "a", "raw", 1, "OK"),  # same time, higher id
        (3, "t", None, "raw", 1, "OK"),
        (4, "u", "a", "raw", 2, "ERROR"),
    )
    gates.gate_tables(fixed, ["t"])
    with pytest.raises(RuntimeError, match="u.a"):
        gates.gate_tables(fixed, ["t", "u"])
    with pytest.raises(RuntimeError, match="never checked: v"):
        gates.gate_tables(fixed, ["t", "v"])
    assert tuple(gates.latest_status(fixed).first()) == (3, 1)


def test_gate_step_and_empty(frame):
    own = log(frame, (1, "t", "a", "s", 1, "OK"), (2, "t", None, "s", 1, "OK"))
    gates.gate_step(own, "s", 2)
    with pytest.raises(RuntimeError, match="2 of 3"):
        gates.gate_step(own, "s", 3)
    broken = own.unionByName(log(frame, (3, "t", "a", "s", 2, "ERROR")))
    with pytest.raises(RuntimeError, match="ERROR"):
        gates.gate_step(broken, "s", 2)
    gates.gate_empty(own.limit(0), "t")
    with pytest.raises(RuntimeError):
        gates.gate_empty(own, "t")


def test_earlier_errors(frame):
    history = log(
        frame, (1, "t", "a", "raw", 1, "ERROR"), (2, "t", "b", "raw", 1, "ERROR"),
        (3, "t", "b", "raw", 2, "OK"), (4, "t", "a", "own", 1, "ERROR"),
    )
    def pair(df):
        r = df.first()
        return r.total_filas_evaluadas, r.registros_afectados

    assert pair(ck.earlier_errors(history, ["raw"], TS, "s")) == (2, 1)
    assert pair(ck.earlier_errors(history, ["none"], TS, "s")) == (1, 1)
    assert pair(ck.log_without_errors(history, TS, "own")) == (1, 1)
    assert pair(ck.log_without_errors(history.filter("id = 3"), TS, "own")) == (1, 0)
    assert {tuple(r) for r in ck.errors_by_table(history).collect()} == {("t", 3)}


@pytest.mark.parametrize("approx", [False, True])
def test_profile(frame, approx):
    df = frame("a int, b string", (10, "a"), (9, "B"), (None, "B"), (9, None))
    got = profile(df, "t", ["a", "b"], TS, "s", table_row=True, approx=approx).collect()
    figures = {
        r.columna: (r.total_filas, r.nulos, r.valores_distintos, r.valor_minimo, r.valor_maximo)
        for r in got
    }
    assert figures == {
        None: (4, None, None, None, None),
        "a": (4, 1, 2, "9", "10"),
        "b": (4, 1, 2, "B", "a"),
    }
    empty = profile(df.limit(0), "t", ["a"], TS, "s").first()
    assert (empty.total_filas, empty.nulos, empty.valores_distintos) == (0, 0, 0)
