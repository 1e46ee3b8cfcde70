"""The fused posterior against the formula, worked out row by row."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from silostar.llm import langid

SYLLABLES = {"en": ["th", "ing", "wh", "ee"], "de": ["sch", "ung", "ei", "ch"], "fr": ["eau", "oi", "que", "ment"]}


def prose(pick, language, words):
    return " ".join("".join(pick.choices(SYLLABLES[language], k=3)) for _ in range(words))


def posterior(model, rows, strength=5.0):
    """rows: (key, text, declared, host, suffix) -> (language, posterior) by key."""
    n, guesses, scores = len(model.languages), [], []
    for _, text, *_ in rows:
        buckets, letters = langid.trigrams(text)
        if not letters or not len(buckets):
            guesses.append(None)
            scores.append(None)
            continue
        mean = model.weights[:, buckets].mean(1)
        guesses.append(int(mean.argmax()))
        scores.append(mean * min(len(buckets), 200) * 0.5)
    total = np.array([1.0 + guesses.count(i) for i in range(n)])
    everywhere = total / total.sum()

    def domain(host):
        found = re.search(r"([^.]+\.)?[^.]+$", host)
        return found[0] if found else ""

    def share(k, value, parent):
        """Among the other rows for which ``value`` gives the same as for this one."""
        own = value(rows[k])
        votes = [g for j, (r, g) in enumerate(zip(rows, guesses)) if j != k and g is not None and value(r) == own]
        counts = np.array([votes.count(i) for i in range(n)], float)
        return (counts + strength * parent) / (len(votes) + strength)

    out = {}
    for k, (key, _, declared, host, suffix) in enumerate(rows):
        if scores[k] is None:
            out[key] = None
            continue
        by_domain = share(k, lambda r: domain(r[3] or ""), everywhere)
        sums = scores[k] + np.log(share(k, lambda r: r[3] or "", by_domain))
        for value, at in ((declared, 2), (suffix, 4)):
            if value:
                sums = sums + np.log(share(k, lambda r: r[at] or "", everywhere) / everywhere)
        e = np.exp(sums - sums.max())
        out[key] = (model.languages[int(sums.argmax())], float(e.max() / e.sum()))
    return out


def test_posteriors_equal_the_formula(frame):
    pick = random.Random(9)
    labelled = [(i, language, prose(pick, language, 20)) for i, language in enumerate(list(SYLLABLES) * 15)]
    model = langid.fit(frame("doc_id long, lang string, text string", *labelled), "doc_id", "text", "lang")
    hosts = ["a.x.org", "b.x.org", "c.de", "", None, "lone.example.net"]
    rows = [
        (k, pick.choice([prose(pick, pick.choice(list(SYLLABLES)), pick.randrange(1, 5)), "xy", "12", "", None, "th " * 300]),
         pick.choice(["en", "de", "xx", "", None]), pick.choice(hosts), pick.choice(["org/en", "de", "", None]))
        for k in range(120)
    ]
    rows.append((900, prose(pick, "de", 1), "only", "alone.io", "io"))  # its own vote alone
    df = frame("k long, text string, declared string, host string, suffix string, best int, domain string", *((*r, 1, "x") for r in rows))
    found = langid.identify(df.repartition(4), model, "k", F.col("text"), F.col("declared"), F.col("host"), F.col("suffix"))
    expected = posterior(model, rows)
    for r in found.collect():
        if expected[r.k] is None:
            assert r.language is None and not r.accepted
        else:
            language, p = expected[r.k]
            assert r.language == language and math.isclose(r.posterior, p, rel_tol=1e-9)


def test_a_column_with_very_many_languages(frame):
    rows = [(i, f"l{i}", f"some words {i}") for i in range(4000)] + [(5000 + i, "zz", "other words") for i in range(5)]
    df = frame("doc_id long, lang string, text string", *rows)
    model = langid.fit(df, "doc_id", "text", "lang", sample=10_000, most_languages=3)
    assert model.languages == ("l0", "l1", "zz") and model.weights.shape == (3, 1 << langid.BITS)


def test_markup_that_does_not_end(frame):
    pages = frame("html string", ("a<script>b</script>c<script " + "x" * 20000,), ("d<!-- e",), ("f<style>g</STYLE >h < i > j",))
    found = [r[0].split() for r in pages.select(langid.text_of(F.col("html"))).collect()]
    assert found == [["a", "c"], ["d"], ["f", "h", "j"]]
