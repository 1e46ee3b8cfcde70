"""Quality and language: exact figures, and accuracy on texts that were not learnt."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from silostar.llm import langid, minhash, quality

WORDS = st.lists(st.sampled_from(["a", "b", "c", "\n", "\r\n", " ", "\x0b", "\x1c", "é", "#$", "|"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(WORDS.map(" ".join) | WORDS.map("".join) | st.text(max_size=40).map(lambda t: t.encode("utf-8", "ignore").decode()))
def test_word_figures(text):
    figures, _ = quality.base_figures(text, minhash.WordHashes())
    assert (*figures, quality.base_failed(figures[0], figures[4])) == brute.word_figures(text)


def made_texts(n, seed):
    """Good prose and bad texts that the fixed rules let pass."""
    pick = random.Random(seed)
    good = lambda: " ".join("".join(pick.choices(["tion", "ing", "the", "er", "an"], k=pick.randrange(1, 4))) for _ in range(60))
    bad = lambda: " ".join("".join(pick.choices(["XX", "QZ", "!!", "$$", "##"], k=3)) for _ in range(60))
    return [(k, good() if k % 4 else bad(), int(k % 4 > 0)) for k in range(n)]


@pytest.fixture
def labelled(frame):
    rows = made_texts(400, 1)
    docs = frame("doc_id long, text string, kept int", *((k, t, 0) for k, t, _ in rows))
    labels = frame("doc_id long, quality int, text string", *((k, y, "z") for k, _, y in rows), (None, 1, None), (9999, None, ""), (3, 7, ""))
    return docs, labels


def test_quality_on_new_texts(frame, labelled):
    model = quality.fit(*labelled, sample=200)
    new = made_texts(100, 2)
    rows = [(k, t) for k, t, _ in new] + [(None, None), (100, ""), (101, "short text"), (5, new[5][1]), (102, "a b c d e " * 30)]
    docs = frame("doc_id long, text string", *rows)
    found = quality.judge(docs, model).collect()
    truth = {k: bool(y) for k, _, y in new}
    assert sum(r.kept == truth[r.doc_id] for r in found if r.doc_id in truth) >= 99
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (None, 100, 101, 102)) and len(found) == 105
    for r, (k, t) in zip(sorted(found, key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r[0]))):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.word_figures(t)
    kept = quality.filter_rows(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)


def test_probabilities_are_calibrated(frame):
    """Texts that look the same and are good three times in four get about that."""
    rows = [(k, f"some words that look alike in all of these texts number {k % 7}", int(k % 4 > 0)) for k in range(400)]
    docs = frame("doc_id long, text string", *((k, t) for k, t, _ in rows))
    model = quality.fit(docs, frame("doc_id long, quality int", *((k, y) for k, _, y in rows)))
    for r in quality.judge(docs.limit(20), model).collect():
        assert 0.6 < r.probability < 0.9


def test_quality_without_labels(labelled, frame):
    docs, labels = labelled
    model = quality.fit(docs, labels.limit(0))
    assert quality.judge(docs, model).filter("kept != (NOT base_failed)").count() == 0
    only_bad = quality.fit(docs, labels.filter("quality = 0"))
    assert quality.judge(docs, only_bad).filter("kept").count() == 0
    assert quality.judge(docs.limit(0), model).count() == 0


def test_the_sample_is_bounded_and_repeats(labelled):
    docs, labels = labelled
    rows = quality.sample_features(docs, labels, "doc_id", "text", "quality", 50)
    assert rows.count() == 50
    again = quality.sample_features(docs.repartition(5), labels.repartition(2), "doc_id", "text", "quality", 50)
    assert {r.key for r in rows.collect()} == {r.key for r in again.collect()}


SYLLABLES = {"en": ["th", "ing", "wh", "ee"], "de": ["sch", "ung", "ü", "ei"], "fr": ["eau", "é", "oi", "que"]}


def prose(pick, language, words):
    return " ".join("".join(pick.choices(SYLLABLES[language], k=3)) for _ in range(words))


@pytest.fixture
def model(frame):
    pick = random.Random(6)
    rows = [(k, language, prose(pick, language, 30)) for k in range(60) for language in SYLLABLES]
    docs = frame("doc_id long, lang string, text string", *((i, *r[1:]) for i, r in enumerate(rows)), (None, "en", "x"), (900, None, "x"))
    return langid.fit(docs, "doc_id", "text", "lang")


def identified(frame, model, rows):
    pages = frame("page_id long, html string, url string, language string, host int", *((*r, "x", 0) for r in rows))
    html, url = F.col("html"), F.col("url")
    return langid.identify(
        pages, model, "page_id", langid.text_of(html), langid.declared_in(html), langid.host_of(url), langid.suffix_of(url)
    )


def test_languages_on_new_pages(frame, model):
    pick = random.Random(7)
    rows = [
        (k, f'<html lang="{language}-XX"><script>{prose(pick, "en", 40)}</script><p>{prose(pick, language, 12)}</p>',
         f"http://{language}.example.com/{language}/{k}")
        for k in range(30) for language in SYLLABLES
    ]
    truth = [language for _ in range(30) for language in SYLLABLES]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    found = {r.page_id: r for r in identified(frame, model, rows).collect()}
    assert all(found[i].language == found[i].declared == t and found[i].accepted for i, t in enumerate(truth))


def test_evidence_beside_the_text_decides_short_texts(frame, model):
    pick = random.Random(8)
    known = [(k, f"<html lang=de><p>{prose(pick, 'de', 20)}", "http://a.example.de/x") for k in range(40)]
    known += [(100 + k, f"<html lang=en><p>{prose(pick, 'en', 20)}", "http://b.example.org/x") for k in range(40)]
    found = {r.page_id: r for r in identified(frame, model, [
        *known, (500, "<html lang=de><p>xyz", "http://a.example.de/y"), (501, "<html lang=en><p>xyz", "http://b.example.org/y"),
    ]).collect()}
    assert found[500].language == "de" and found[501].language == "en"


def test_pages_without_evidence(frame, model):
    rows = [(None, None, None), (1, "", ""), (2, "<p>123 ...</p>", "no address"), (2, "<p>123 ...</p>", "no address"),
            (3, "<p>whthing wheeing thee</p>", None), (4, "the " * 20000, "http://x")]
    found = identified(frame, model, rows).collect()
    assert len(found) == 6
    assert all(r.language is None and not r.accepted for r in found if r.page_id in (None, 1, 2))
    assert {r.language for r in found if r.page_id in (3, 4)} == {"en"}


def test_no_pages_and_no_labels(frame, model):
    assert identified(frame, model, []).count() == 0
    unlabelled = langid.fit(frame("doc_id long, lang string, text string"), "doc_id", "text", "lang")
    (row,) = identified(frame, unlabelled, [(1, "<p>some words</p>", "http://a.b/")]).collect()
    assert row.language == "und"
