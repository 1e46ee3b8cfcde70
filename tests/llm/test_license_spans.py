"""License alignments against a plain version: changed words at every place, stray k-grams,
many copies, templates as a table."""

import random

import pytest

from silostar.llm import license_scan as ls

SHORT = {"alpha": "a b c d e f g h i j k l m n o p q r", "beta": "x y z x y z v w x y z u t s"}


def chain(words, template, k=3):
    """The longest in-order chain of template k-grams within less than twice the template:
    its share of them."""
    t = template.split()
    grams = [tuple(t[i : i + k]) for i in range(len(t) - k + 1)]
    votes = [
        (w, a) for w in range(len(words) - k + 1) for a, gram in enumerate(grams) if tuple(words[w : w + k]) == gram
    ]
    best = 0
    for start, _ in votes:
        part = [(w, a) for w, a in votes if start <= w < start + 2 * len(grams)]
        length = {}
        for w, a in part:
            length[w, a] = 1 + max((n for (x, b), n in length.items() if x < w and b < a), default=0)
        best = max(best, *length.values())
    return best / len(grams)


def scanned(docs, texts, templates, **options):
    return [r.spans for r in sorted(ls.scan(docs(*texts), templates=templates, **options).collect())]


def changed(words, pick):
    for i in range(len(words) + 1):
        yield [*words[:i], "new", *words[i:]]
    for i in range(len(words)):
        yield words[:i] + words[i + 1 :]
        yield [*words[:i], "other", *words[i + 1 :]]
    for _ in range(10):  # several changes
        some = list(words)
        for _ in range(3):
            some.insert(pick.randrange(len(some)), "new")
        yield some


@pytest.mark.parametrize("name", ["apache", "mit", "gpl", "alpha", "beta"])
def test_a_template_with_changed_words(docs, name):
    """Found where the plain version finds enough of it, with the same score."""
    pick = random.Random(4)
    template = (ls.TEMPLATES | SHORT)[name]
    words = template.split()
    strays = [" ".join(words[i : i + 3]) for i in range(0, len(words) - 3, 4)]
    texts = []
    for some in changed(words, pick):
        before = " ".join(pick.choice([*strays, "noise", "some text"]) for _ in range(pick.randrange(4)))
        texts.append(f"{before} filler {' '.join(some)} filler {pick.choice(strays)}")
    found = scanned(docs, texts, {name: template})
    scores = [max((s.score for s in spans), default=0) for spans in found]
    plain = [chain(t.split(), template) for t in texts]
    # Strays on near diagonals may lengthen a plain chain; they never hide a license.
    assert all((s > 0) == (p >= ls.COVERAGE) or s >= ls.COVERAGE for s, p in zip(scores, plain))
    assert all(s >= ls.COVERAGE for s, p in zip(scores, plain) if p >= ls.COVERAGE + 0.1)
    assert all(s <= p + 1e-9 for s, p in zip(scores, plain))


def test_single_insertions_into_every_template_are_found(docs):
    texts, names = [], []
    for name, template in ls.TEMPLATES.items():
        words = template.split()
        if len(words) > 12:
            texts += [" ".join([*words[:i], "inserted", *words[i:]]) for i in range(len(words) + 1)]
            names += [name.removesuffix("-notice")] * (len(words) + 1)
    for name, spans in zip(names, scanned(docs, texts, ls.TEMPLATES)):
        assert name in {s.label for s in spans}


def test_copies_and_their_places(docs):
    template = SHORT["alpha"]
    texts = [f"{template} gap {template} {template}", "no " * 50 + template, "a b c " * 400, " ".join([template] * 60)]
    found = scanned(docs, texts, {"alpha": template})
    assert [(s.first, s.last, s.score) for s in found[0]] == [(0, 15, 1.0), (19, 34, 1.0), (37, 52, 1.0)]
    assert [(s.first, s.last) for s in found[1]] == [(50, 65)]
    assert found[2] == [] and len(found[3]) == 60


def test_templates_as_a_table(docs, frame):
    table = frame("name string, text string, at int", ("alpha", "A b C, d e f", 1), ("short", "a b", 2), ("none", None, 3))
    found = scanned(docs, ["x a b c d e f", "a b"], table)
    assert [(s.label, s.first, s.last, s.score) for s in found[0]] == [("alpha", 1, 4, 1.0)] and found[1] == []


def test_letters_beyond_ascii_stay(docs):
    """The Kelvin sign is no k."""
    found = scanned(docs, ["this worK here now", "this work here now"], {"t": "this work here now"})
    assert found[0] == [] and len(found[1]) == 1
