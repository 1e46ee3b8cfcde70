"""Ids and other numbers beyond what a double holds, beside nulls, through every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from silostar.llm import (
    conversation_repair, embedding_dedup, fingerprint, langid, license_scan, minhash, packing, piece_sampling, prefix_trie,
    quality, secret_scan, token_counts, url_filter,
)

BIG = 2**53 + 1
IDS = [BIG, None, BIG + 1, -BIG, 0]
TEXTS = [" ".join(f"word{i}x{j}" for j in range(15)) for i in range(len(IDS))]


@pytest.fixture
def texts(frame):
    """One partition, so that the null shares a batch with the others."""
    rows = frame("doc_id long, text string, n_chars long, lang string, source string", *(
        (k, t, k, "en", "s") for k, t in zip(IDS, TEXTS)
    ))
    return rows.coalesce(1)


def ids(df, key="doc_id"):
    return sorted((r[0] for r in df.select(key).collect()), key=repr)


def test_text_operators(texts, frame, tmp_path, bytes_file, words_file, pieces_file):
    expected = sorted(IDS, key=repr)
    model = quality.fit(texts, frame("doc_id long, quality int"))
    assert ids(quality.judge(texts, model)) == expected
    kept = quality.filter_rows(texts, model)
    assert ids(kept) == ids(kept, "n_chars") == expected
    assert sorted(set(ids(packing.pack(texts, words_file))), key=repr) == expected
    assert ids(minhash.read_sets(texts, "doc_id", "text", 4), "key") == expected
    found = minhash.duplicates(texts, width=4)
    assert ids(found) == ids(found, "component_id") == expected and found.filter("NOT kept").count() == 0
    assert ids(piece_sampling.encode(texts, pieces_file)) == expected
    assert ids(license_scan.scan(texts)) == ids(secret_scan.scan(texts)) == expected
    assert ids(token_counts.count_tokens(texts, bytes_file, str(tmp_path))) == expected
    assert ids(fingerprint.fingerprints(texts)) == expected
    learnt = langid.fit(texts, "doc_id", "text", "lang")
    none = F.lit(None).cast("string")
    assert ids(langid.identify(texts, learnt, "doc_id", F.col("text"), none, none, none)) == expected


def test_other_operators(frame):
    expected = sorted(IDS, key=repr)
    pages = frame("page_id long, url string", *((k, "http://a.b/") for k in IDS)).coalesce(1)
    assert ids(url_filter.judge_urls(pages, url_filter.RULES), "page_id") == expected
    vectors = frame("vec_id long, label string, embedding array<float>", *(
        (k, "l", [float(i == j) for j in range(5)]) for i, k in enumerate(IDS)
    )).coalesce(1)
    found = embedding_dedup.duplicates(vectors)
    assert ids(found, "vec_id") == ids(found, "component_id") == expected
    talk = frame("conv_id long, turn long, role string, text string", *((k, BIG, "user", f"Hi {k}.") for k in IDS)).coalesce(1)
    assert ids(conversation_repair.repair(talk), "conv_id") == expected
    top = {r.conv_id for r in prefix_trie.trie(talk).filter("depth = 1").collect()}
    assert top <= set(IDS) - {None}
    assert public_tokenizers.path("word_bpe_49k.json")
