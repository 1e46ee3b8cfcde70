"""The registered queries and the stages over tables in the layout of the given ones."""

import random
import re

import pytest

import brute
import corpus_pipeline
from compare import connect, differences
from silostar.llm.oracle import ORACLE
from silostar.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(2)
    word = lambda: "".join(pick.choices(["the", "tion", "er", "an", "wh"], k=pick.randrange(1, 5)))
    prose = lambda n=40: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for k in range(120):
        bad = k % 5 == 0
        rows.append([k, "".join(f"QX{pick.randrange(99)}$$ " for _ in range(30)) if bad else prose(), "en", f"s{k % 6}", 1])
        labels.append((k, int(not bad), 0))
    rows[1][1] = rows[2][1] = prose(60)
    rows[3][1] = rows[1][1] + " extra"
    rows[4][1] += " token = " + "0123456789abcdef" * 2
    rows += [[k, None, None, None, None] for k in (200, None)] + [[7, *rows[7][1:]], [201, "12 " * 40, "en", "s1", 1]]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {tuple(r[:2]) for r in rows}


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(path)), "test")
        assert docs.columns == columns
        seen[name] = docs.collect()
    ids = lambda name: sorted(r.doc_id for r in seen[name])
    good = [k for k in range(120) if k % 5]
    assert ids("quality rules") == sorted([*good, 7])
    assert ids("language ID") == sorted([*good, 7])
    texts = {k: before[k] for k in good}
    assert ids("MinHash near-dedup") == sorted(k for k, (_, c) in brute.near_duplicates(texts, 5).items() if k == c)
    assert {2, 3}.isdisjoint(ids("MinHash near-dedup")) and ids("MinHash near-dedup").count(7) == 1
    after = {r.doc_id: r for r in seen["secret scans"]}
    assert after.keys() == set(ids("MinHash near-dedup"))
    assert after[4].text == re.sub("token.*", "[SECRET]", before[4]) and after[4].n_chars == len(after[4].text)
    assert all(r.text == before[k] for k, r in after.items() if k != 4)
    pieces = corpus_pipeline.run(spark, str(path)).collect()
    assert {r.doc_id for r in pieces} == after.keys()


def test_stages_on_an_empty_table(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(path)).count() == 0


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        assert differences(df, database, ORACLE[name]) == []
    else:
        source = "pages" if "page_id" in df.columns else "documents"
        key = df.columns[0]
        ids = {r[0] for r in database.sql(f"SELECT {key} FROM {source}").fetchall()}
        assert {r[0] for r in df.select(key).collect()} == ids


@pytest.mark.parametrize("name, key, columns, plain", [
    ("op1_quality", "doc_id", ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], brute.word_figures),
    ("op8_license_scan", "doc_id", ["n_words", "n_base", "first_word", "last_word", "base_labels"], brute.licenses),
    ("op10_secret_scan", "doc_id", ["n_assign", "n_access", "n_hex", "base_sha256"], lambda t: brute.secrets(t)[0]),
])
def test_query_against_brute_force(spark, database, name, key, columns, plain):
    texts = dict(database.sql("SELECT doc_id, text FROM documents").fetchall())
    for row in QUERIES[name](spark, FOLDER).collect():
        assert tuple(row[c] for c in columns) == plain(texts[row[key]])
