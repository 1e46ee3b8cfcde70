"""Near duplicates, embeddings and components against brute force."""

import random

import numpy as np
import pytest

import brute
from silostar.llm import embedding_dedup, minhash
from silostar.llm.components import components


@pytest.mark.parametrize("seed", [1, 2])
def test_components(frame, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    found = components(frame("a long, b long", *links, *links[:5], (None, 3), (4, None), (7, 7)))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert dict(map(tuple, found.collect())) == brute.components(nodes, [l for l in links if l[0] != l[1]])


def test_components_of_a_star(frame):
    found = components(frame("a long, b long", *((500, i) for i in range(300))))
    assert {r.component for r in found.collect()} == {0} and found.count() == 301


def test_no_links(frame):
    assert components(frame("a long, b long")).count() == 0


def corpus():
    """Groups of near copies around templates, with more and fewer changes."""
    pick = random.Random(11)
    word = lambda: "".join(pick.choices("abcdefgh", k=6))
    texts = {}
    for size, length in ((30, 150), (12, 60), (6, 12), (3, 400), (2, 30)):
        template = [word() for _ in range(length)]
        for _ in range(size):
            copy = list(template)
            for _ in range(pick.randrange(1 + length // 25)):
                copy[pick.randrange(length)] = word()
            texts[len(texts)] = " ".join(copy)
    shared = [word() for _ in range(40)]  # a passage that very different texts share
    for _ in range(15):
        texts[len(texts)] = " ".join([*shared, *(word() for _ in range(40))])
    for t in (None, "", " \n", "a", "A", "a b", "b a", "a b c d", "a  b\tc\nd", "É x y z", "é x y z", texts[0], texts[0].upper()):
        texts[len(texts)] = t
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, width):
    texts = corpus()
    order = list(texts)
    random.Random(3).shuffle(order)
    rows = docs(*(texts[i] for i in order), ids=order)
    found = minhash.duplicates(rows.repartition(3), width=width).collect()
    expected = brute.near_duplicates(texts, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_with_blocks_and_runs(docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "RUN", 3)
    texts = {i: t for i, t in corpus().items() if i < 45}
    found = minhash.duplicates(docs(*texts.values())).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(texts, 5)


def test_a_best_partner_is_named_once_for_all_buckets(frame):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**16, minhash.COORDINATES, dtype=np.uint16)
    rows = {}
    for k in range(12):
        changed = base.copy()
        changed[rng.choice(len(base), 30, replace=False)] += 1 + k
        rows[bytes([k])] = changed
    sketches = frame("node binary, sketch binary", *((n, r.tobytes()) for n, r in rows.items()))
    members = frame("bucket long, node binary", *((bucket, n) for bucket in range(40) for n in rows))
    labels = frame("node binary, component binary").limit(0)
    found = [(bytes(r.a), bytes(r.b), r.agreement) for r in minhash.best_pairs(minhash.open_members(members, labels), sketches).collect()]
    assert len(found) == len(set(found)) == 2 * len(rows)
    for b, own in rows.items():
        most = max((own == other).mean() for a, other in rows.items() if a != b)
        assert max(agreement for _, partner, agreement in found if partner == b) == most


def test_blocks_alone_have_a_row_for_each_member(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    members = frame("bucket long, node binary", *((bucket, bytes([n])) for bucket in range(3) for n in range(20)))
    alone = minhash.open_members(members, frame("node binary, component binary").limit(0), across=False)
    assert alone.count() == 60 and alone.filter("x <> y").count() == 0
    assert alone.select("bucket", "x").distinct().count() > 3


def test_null_and_repeated_ids(docs):
    found = minhash.duplicates(docs("a b c", "a b c", "a b c", "a b c", None, ids=[None, 4, 4, 2, None])).collect()
    got = sorted(map(tuple, found), key=repr)
    assert got == sorted(
        [(None, 1, None, True), (4, 1, 2, False), (4, 1, 2, False), (2, 1, 2, True), (None, 0, None, True)], key=repr
    )


def test_one_id_with_two_texts(docs):
    found = minhash.duplicates(docs("a b c d e f", "g h i j k l", "g h i j k l", ids=[1, 1, 3])).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (3, 1)]


def test_no_documents(docs):
    assert minhash.duplicates(docs("a").limit(0)).count() == 0


def test_less_similar_pairs_are_refused(docs):
    with pytest.raises(ValueError):
        minhash.duplicates(docs("a"), similarity=0.5)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    for size in (1, 5, 60, 3000):
        for share in (0.5, 0.8, 1.0):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            n = int(size * share)
            one = np.unique(np.concatenate([both[:n], rng.integers(0, 2**63, size - n, dtype=np.uint64)]))
            a, b = minhash.sketches([np.unique(both), one])
            exact = len(np.intersect1d(both, one)) / len(np.union1d(both, one))
            assert abs((a == b).mean() - exact) < 0.13


def test_a_sketch_does_not_depend_on_its_batch():
    sets = [np.unique(np.random.default_rng(k).integers(0, 2**63, 7 * k + 1, dtype=np.uint64)) for k in range(20)]
    together = minhash.sketches([*sets, sets[0][:0]])
    assert all((minhash.sketches([s])[0] == row).all() for s, row in zip(sets, together))


def vectors(n, groups, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    return {
        i: (centres[i % groups] + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.15, 2.0])).tolist() for i in range(n)
    }


def embedded(frame, data, labels):
    rows = [(i, v, labels[i], 9) for i, v in data.items()]
    return frame("vec_id long, embedding array<double>, label int, n_links int", *rows)


def check(rows, data, labels):
    expected = brute.vector_groups(data, labels)
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_embeddings(frame):
    data = vectors(400, 12)
    labels = {i: i % 3 for i in data}
    nan, inf = float("nan"), float("inf")
    for v in (None, [], [0.0] * 16, [nan] * 16, [inf] + [1.0] * 15, [None] + [1.0] * 15, data[0], data[0], data[0][:8],
              [2 * x for x in data[0]], [1e-200 * x for x in data[0]], [1e200 * x for x in data[0]], [-x for x in data[0]]):
        labels[len(data)] = 0
        data[len(data)] = v
    for _ in range(2):
        labels[len(data)] = None
        data[len(data)] = data[0]
    check(embedding_dedup.duplicates(embedded(frame, data, labels).repartition(3)).collect(), data, labels)


def test_forest_with_small_leaves_and_blocks(frame, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)
    data = vectors(300, 6)
    labels = dict.fromkeys(data, 1)
    check(embedding_dedup.duplicates(embedded(frame, data, labels), leaf=10).collect(), data, labels)


def test_one_tight_group_that_no_cut_parts(frame):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(16)
    data = {i: (centre + 0.01 * rng.standard_normal(16)).tolist() for i in range(200)}
    labels = dict.fromkeys(data, 1)
    check(embedding_dedup.duplicates(embedded(frame, data, labels), leaf=20).collect(), data, labels)


def test_null_and_repeated_vector_ids(frame):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (None, [0.0, -1.0], 2)]
    found = embedding_dedup.duplicates(frame("vec_id long, embedding array<double>, label int", *rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(None, 2, 5, True), (5, 2, 5, True), (5, 2, 5, True), (3, 0, 3, True), (None, 0, None, True)], key=repr
    )


def test_no_vectors(frame):
    assert embedding_dedup.duplicates(frame("vec_id long, embedding array<double>, label int")).count() == 0
