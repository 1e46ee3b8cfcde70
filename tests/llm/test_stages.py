"""The pipeline's stages on ids that repeat, null ids, and columns named like their own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from silostar.llm import tokens
from silostar.llm.common import free_name

A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
BIG = 2**53 + 1
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
OWN = "row string, id string, spans string, text_hash string, `key` string, text_language string, _row string, kept boolean, least int"


def docs(frame, *rows):
    return frame(SCHEMA, *((k, t, "en", f"s{k}", k) for k, t in rows))


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_texts_that_share_an_id_are_told_apart(spark, frame):
    found = pipeline.near_dedup(spark, docs(frame, (1, A), (5, A), (5, B)), "")
    assert kept(found) == [(1, A), (5, B)]


def test_null_and_repeated_rows(spark, frame):
    near = A + " more"
    rows = [(None, A), (7, near), (None, B), (None, B), (BIG, "x y z " + B[:5]), (BIG, "x y z " + B[:5]), (-3, near), (9, None), (9, None), (10, "")]
    found = pipeline.near_dedup(spark, docs(frame, *rows).coalesce(1), "")
    assert kept(found) == sorted(
        [(-3, near), (None, B), (BIG, "x y z " + B[:5]), (9, None), (10, "")], key=repr
    )


def test_one_of_rows_that_repeat_id_and_text_stays(spark, frame):
    rows = [(1, A, "en", "s2", 5), (1, A, "en", "s1", 9), (1, A, "en", None, 7)]
    (row,) = pipeline.near_dedup(spark, frame(SCHEMA, *rows).repartition(3), "").collect()
    assert tuple(row) == (1, A, "en", None, 7)


def test_columns_named_like_those_of_the_stages(spark, frame, tmp_path):
    frame("doc_id long, quality int", (1, 1)).write.parquet(f"{tmp_path}/labels.parquet")
    secret = B + " token = " + "0123456789abcdef" * 2
    own = ("r", "i", "s", "h", "k", "l", "u", True, 3)
    rows = [(k, t, "en", f"s{k}", 4, *own) for k, t in ((1, A), (2, secret), (BIG, A))]
    df = frame(f"{SCHEMA}, {OWN}", *rows, (None, A.replace("alpha", "gamma"), "en", "s", BIG, *own)).coalesce(1)
    columns = df.columns
    for _, stage in pipeline.STAGES[:-1]:
        df = pipeline.stored(stage(spark, df, str(tmp_path)), "test")
        assert df.columns == columns
    found = {r.doc_id: r for r in df.collect()}
    assert found.keys() == {1, 2, None} and all(tuple(r)[5:] == own for r in found.values())
    assert found[2].text == B + " [SECRET]" and found[2].n_chars == len(found[2].text)
    assert found[None].n_chars == BIG
    assert pipeline.pack(spark, df, str(tmp_path)).count() >= 3


def test_free_names(frame):
    assert free_name(frame("a int"), "row") == "row"
    assert free_name(frame("Row int, _row int"), "row") == "__row"


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_a_text_of_millions_of_characters(spark, frame, tmp_path, stage):
    frame("doc_id long, quality int", (1, 1)).write.parquet(f"{tmp_path}/labels.parquet")
    long = " ".join(f"word{i % 5000}of{i}" for i in range(150_000))
    found = stage(spark, docs(frame, (1, long), (2, A), (3, "x" * 500_000)), str(tmp_path))
    assert {1, 2} <= {r.doc_id for r in found.select("doc_id").collect()}


def test_a_task_packs_more_distinct_words_than_it_keeps(spark, words_file):
    """Words of the first batch come again beside new ones when their ids are let go."""
    each, n = 3000, tokens.MAX_WORDS // 3000 + 100
    first = F.least("id", F.lit(n)) * each
    words = F.array_join(F.sequence(first, first + each - 1), " ")
    text = F.when(F.col("id") < n, words).otherwise(F.concat(words, F.lit(" 0 17 2999")))
    df = spark.range(0, n + 2, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = {r.doc_id: r for r in pipeline.pack(spark, df, "").groupBy("doc_id").agg(
        F.sum("length").alias("length"), F.max("doc_tokens").alias("tokens")).collect()}
    assert found.keys() == set(range(n + 2)) and all(r.length == r.tokens for r in found.values())
    library = tokens.load(words_file)
    for r in df.filter(F.col("doc_id").isin(0, 1, n - 1, n, n + 1)).collect():
        assert found[r.doc_id].tokens == len(library.encode(r.text, add_special_tokens=False).ids) + 1
