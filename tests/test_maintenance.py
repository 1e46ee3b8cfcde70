from datetime import datetime

from pyspark.sql import functions as F

import pytest

from silostar.operators import history, keys, merge, ranking
from silostar.sources.tables import Warehouse

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_assign_keys_dense_and_stable(frame):
    first = frame("n string", *[(f"k{i}",) for i in range(50)])
    known = keys.assign_keys(first, ["n"], "key")
    got = dict((r.n, r.key) for r in known.collect())
    assert sorted(got.values()) == list(range(1, 51))
    again = keys.assign_keys(first.repartition(7), ["n"], "key")
    assert got == dict((r.n, r.key) for r in again.collect())
    more = keys.assign_keys(frame("n string", ("x",), ("y",)), ["n"], "key", existing=known)
    assert sorted(r.key for r in more.collect()) == [51, 52]
    empty = keys.assign_keys(first.limit(0), ["n"], "key", existing=known.limit(0))
    assert empty.count() == 0


def test_assign_keys_interleaved(frame):
    first = frame("n string", *[(f"k{i}",) for i in range(50)])
    known = keys.assign_keys(first, ["n"], "key", bucket_digits=1, dense=False)
    got = [r.key for r in known.collect()]
    assert len(set(got)) == 50 and min(got) >= 1
    assert max(got) <= 16 * 50
    more = keys.assign_keys(
        frame("n string", ("x",), ("y",)), ["n"], "key", known, bucket_digits=1, dense=False
    )
    fresh = [r.key for r in more.collect()]
    assert len(set(fresh)) == 2 and min(fresh) > max(got)


def test_insert_new(frame):
    target = frame("k int, v string", (1, "old"))
    new = frame("k int, v string", (1, "new"), (2, "b"), (2, "a"), (3, "c"))
    assert rows(merge.insert_new(new, target, ["k"])) == [(2, "a"), (3, "c")]
    assert rows(merge.insert_new(new, target, ["k"], [F.desc("v")])) == [(2, "b"), (3, "c")]
    assert rows(merge.insert_new(new.select("k"), target, ["k"])) == [(2,), (3,)]


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    def table(name, n):
        spark.range(n).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    target = table("target", 10_000)
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    with wh.transaction():
        batch = wh.intermediate(table("batch", 100).join(table("more", 100), ["k", "v"]))
        lines = merge.not_present(batch, target, ["k"])._jdf.queryExecution().executedPlan()
        text = lines.toString().splitlines()
    semi = next(i for i, line in enumerate(text) if "LeftSemi" in line)
    scan = next(i for i, line in enumerate(text) if i > semi and "FileScan" in line)
    assert "BroadcastHashJoin" in text[semi]
    assert not any("Exchange" in line for line in text[semi:scan])
    assert "ReadSchema: struct<k:bigint>" in text[scan]


def test_intermediate_tables_end_with_the_transaction(spark, frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    with wh.transaction():
        kept = wh.intermediate(frame("a int", (1,)))
        assert rows(kept) == [(1,)] and all(wh.root in f for f in kept.inputFiles())
        assert rows(wh.intermediate(frame("a int").limit(0))) == []
    assert list((tmp_path / "_intermediate").iterdir()) == []
    with pytest.raises(RuntimeError):
        wh.intermediate(frame("a int"))


def test_scd1_update(frame):
    dim = frame("k int, a string, b string", (1, "x", "p"), (2, "y", "q"))
    changed = frame("k int, a string, b string", (1, None, "z"), (9, "n", "n"))
    got = merge.scd1_update(dim, changed, ["k"], ["a"])
    assert rows(got) == [(1, None, "p"), (2, "y", "q")]


def test_upsert(frame):
    target = frame("k int, v int, kept string", (1, 1, "a"), (2, 2, "b"))
    source = frame("k int, v int, kept string", (2, 20, "other"), (3, 30, "c"))
    assert rows(merge.upsert(target, source, ["k"], ["v"])) == [(1, 1, "a"), (2, 20, "b"), (3, 30, "c")]


def test_ensure_columns_and_default(frame):
    df = frame("a int", (1,))
    assert merge.ensure_columns(df, {"a": "int", "b": "double"}).dtypes == [("a", "int"), ("b", "double")]
    default = frame("a int", (0,))
    assert rows(merge.or_default(df, default)) == [(1,)]
    assert rows(merge.or_default(df.filter("a > 1"), default)) == [(0,)]


def test_latest_and_top(frame):
    df = frame(
        "k string, t timestamp_ntz, id int", ("a", T1, 1), ("a", T1, 2), ("a", None, 3), (None, T2, 4),
        (None, T1, 5),
    )
    # a missing time sorts first when descending
    assert rows(ranking.latest(df, ["k"], "t", "id").select("id")) == [(3,), (4,)]
    scores = frame("c string, s int", ("a", 1), ("a", 5), ("b", 2))
    assert rows(ranking.top_per_key(scores, ["c"], "s")) == [("a", 5), ("b", 2)]
    plan = ranking.latest(df, ["k"], "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # pruned before the shuffle as well


ATTRIBUTES = ("a", "b")
SCHEMA = "k int, a string, b string"


def state(h):
    return rows(h.select("k", "a", "b", "vigente_desde", "vigente_hasta", "es_vigente"))


def test_scd2(frame):
    start = history.scd2_init(
        frame(SCHEMA, (1, "x", None), (2, "y", "q"), (3, "z", "r")), ["k"], ATTRIBUTES, T1
    )
    # unchanged (a blank equals a null), changed, new
    delta = frame(SCHEMA, (1, "x", ""), (2, "y", "new"), (4, "n", "n"))
    after = history.scd2_apply(start, delta, ["k"], ATTRIBUTES, T2)
    assert state(after) == [
        (1, "x", None, T1, None, 1),
        (2, "y", "new", T2, None, 1),
        (2, "y", "q", T1, T2, 0),
        (3, "z", "r", T1, None, 1),
        (4, "n", "n", T2, None, 1),
    ]
    # the same delta again changes nothing
    assert state(history.scd2_apply(after, delta, ["k"], ATTRIBUTES, T3)) == state(after)
    # closed versions are not touched by a later change, even back to an old value
    back = history.scd2_apply(after, frame(SCHEMA, (2, "y", "q")), ["k"], ATTRIBUTES, T3)
    assert [r for r in state(back) if r[0] == 2] == [
        (2, "y", "new", T2, T3, 0), (2, "y", "q", T1, T2, 0), (2, "y", "q", T3, None, 1),
    ]
    open_versions = back.filter("es_vigente = 1").groupBy("k").count()
    assert open_versions.filter("count <> 1").isEmpty() and open_versions.count() == 4


def test_scd2_null_to_value(frame):
    start = history.scd2_init(frame(SCHEMA, (1, None, None)), ["k"], ATTRIBUTES, T1)
    after = history.scd2_apply(start, frame(SCHEMA, (1, "v", None)), ["k"], ATTRIBUTES, T2)
    assert len(state(after)) == 2
