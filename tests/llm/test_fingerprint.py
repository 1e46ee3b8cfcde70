"""Fingerprints against a plain version, and their sums."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from silostar.llm import fingerprint as fp

SCHEMA = "doc_id long, text string"
BIG = 2**53 + 1
MOD = 1 << 60


def plain(text):
    entries = [0] * 45
    for part in re.findall(r"[^\n.!?]*[.!?]+|[^\n.!?]+", text or ""):
        part = part.strip(" ")
        if part:
            digest = hashlib.sha256(part.encode()).hexdigest()
            numbers = [int(digest[15 * k : 15 * k + 15], 16) for k in range(4)]
            bits = [(n >> j) & (1 | 1 << 20 | 1 << 40) for n in numbers[:2] for j in range(20)]
            entries = [(a + b) % MOD for a, b in zip(entries, [1, *numbers, *bits])]
    return entries


def cosine(a, b):
    def lanes(entries):
        return [2 * ((v >> f) % 2**20) - entries[0] for v in entries[5:] for f in (0, 20, 40)]

    a, b = lanes(a), lanes(b)
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    norms = dot(a, a) * dot(b, b)
    return 1.0 if a == b else min(1.0, max(0.0, dot(a, b) / norms**0.5)) if norms else 0.0


def expected(rows):
    texts = [t or "" for _, t in rows]
    out = []
    for (key, _), text, after in zip(rows, texts, texts[1:] + texts[:1]):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = plain(text), plain(edited), plain(after)
        out.append((key, len(text), edited, a, b, round(cosine(a, b), 9), round(cosine(a, c), 9)))
    return sorted(out, key=repr)


def result(df):
    rows = fp.fingerprints(df).collect()
    return sorted((
        (r.doc_id, r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
        for r in rows
    ), key=repr)


def prose(pick, n):
    return "".join(pick.choice(["one. ", "two\n", "three! ", "Zürich", "😀? ", " ", "four.\n\n"]) for _ in range(n))


@pytest.mark.parametrize("bucket", [4096, 4])
def test_against_a_plain_version(frame, monkeypatch, bucket):
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket)
    pick = random.Random(5)
    rows = [(k * 7 - 40, prose(pick, pick.randrange(0, 30))) for k in range(40)]
    rows += [(BIG, None), (BIG + 1, ""), (BIG + 2, "x" * 5000 + "."), (2000, rows[3][1])]
    rows = [(None, "First. Of all"), *sorted(rows)]
    df = frame(SCHEMA + ", bucket string, fingerprint long", *((*r, "x", 1) for r in rows)).repartition(5)
    assert result(df) == expected(rows)


def test_one_row_and_none(frame):
    assert result(frame(SCHEMA)) == []
    assert result(frame(SCHEMA, (3, "ab. cd"))) == expected([(3, "ab. cd")])


def test_an_id_and_a_row_with_a_third_of_all_rows(frame, monkeypatch):
    """Rows that share an id follow each other by the hash of their text; all copies but the
    last of a row are followed by a copy."""
    monkeypatch.setattr(fp, "BUCKET_ROWS", 6)
    rows = [(k, f"text {k}. more") for k in range(60)] + [(30, f"other {k}.") for k in range(30)]
    rows += [(40, "same. text")] * 30
    df = frame(SCHEMA, *rows).repartition(4)
    spark = df.sparkSession
    hashes = {r.text: r.h for r in df.select("text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h")).collect()}
    rows.sort(key=lambda r: (r[0], hashes[r[1]]))
    assert result(df) == expected(rows)
    assert spark is not None


def test_sums(spark):
    a, b = "One. Two.\nThree", "Four!\nTwo."
    df = spark.createDataFrame([(a, b, f"{a}\n{b}", "Three\nTwo. One.")], "a string, b string, ab string, other string")
    for c in df.columns:
        df = fp.with_fingerprint(df, c, f"f_{c}")
    row = df.select(
        (fp.added(F.col("f_a"), F.col("f_b")) == F.col("f_ab")).alias("added"),
        (fp.removed(F.col("f_ab"), F.col("f_b")) == F.col("f_a")).alias("removed"),
        (F.col("f_a") == F.col("f_other")).alias("reordered"),
        (F.col("f_a") != F.col("f_b")).alias("different"),
        fp.listed(F.col("f_a")).alias("text"),
    ).first()
    assert row.added and row.removed and row.reordered and row.different and len(row.text) == 45 * 15


def test_no_python_in_the_plan(frame):
    text = fp.fingerprints(frame(SCHEMA, (1, "a."), (2, "b.")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
