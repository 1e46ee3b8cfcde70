"""Token counts, packing and sampled pieces against the libraries themselves."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silostar.llm import packing, piece_sampling, token_counts, tokens
from silostar.llm.common import new_path

TEXTS = [
    None, "", " ", "a", "  two  spaces ", "line\nend", "a\n\nb <|endoftext|> c", "don't 'S we're", "É́ x ſ K",
    "naïve\tfoo\x1cbar", "日本 語 \U0001f600", "</w> a</w>", "x" * 5000, "word " * 3000, "<|ENDOFTEXT|>a<|endoftext|>",
]
ALPHABET = st.sampled_from(list("aB'é.1 \n\t<|>#") + ["<|endoftext|>", "  ", "the ", " ", "́", "日"])
SOME_TEXT = st.lists(ALPHABET, max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(SOME_TEXT, min_size=1, max_size=4))
def test_counts_are_those_of_whole_texts(bytes_file, texts):
    whole = [len(e.ids) for e in tokens.load(bytes_file).encode_batch(texts, add_special_tokens=False)]
    assert tokens.ByteLevelCounts(bytes_file)(texts) == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(SOME_TEXT, min_size=1, max_size=4))
def test_ids_are_those_of_whole_texts(words_file, texts):
    whole = [e.ids for e in tokens.load(words_file).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in tokens.WordLevelIds(words_file)(texts)] == whole


def test_words_of_latin_letters_need_no_whole_tokenizer(words_file):
    words = "élan Straße ÀÉÎ naïve, l'été n'Ès ÿÞø 9é9 Äußerung! ×2 a÷b É́t ſé".split()
    whole = [e.ids for e in tokens.load(words_file).encode_batch(words, add_special_tokens=False)]
    encoder, seen = tokens.WordLevelIds(words_file), []

    class Recorded:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return tokens.load(words_file).encode_batch_fast(texts, **options)

    encoder.tokenizer = Recorded()
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(words)] == whole
    assert sorted(seen) == sorted(["×2", "a÷b", "É́t", "ſé"])


@pytest.mark.parametrize("limit, most", [("MAX_WORDS", 12), ("MAX_BYTES", 200)])
def test_ids_do_not_depend_on_the_words_that_are_kept(words_file, monkeypatch, limit, most):
    """Batches mix new words with such as were met before; what is kept stays bounded."""
    monkeypatch.setattr(tokens, limit, most, raising=False)
    library, encoder, kept = tokens.load(words_file), tokens.WordLevelIds(words_file), []
    for k in range(60):
        texts = [f"the word{k}, the 日本{k % 7} naïve{k % 3}", TEXTS[k % len(TEXTS)] or "", f"word{k // 2}, b{k}"]
        whole = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)] == whole
        kept.append(len(encoder.known))
    assert sum(after < before for before, after in zip(kept, kept[1:])) > 5  # started anew
    assert max(kept) < 30
    assert encoder.held == sum(len(word) + len(ids) for word, ids in encoder.known.items())


def library_count(path, text):
    return len(tokens.load(path).encode(text or "", add_special_tokens=False).ids)


def test_count_tokens(spark, docs, bytes_file):
    cache = new_path(spark, "cache")
    texts = [*TEXTS, "a", "line\nend"]
    found = token_counts.count_tokens(docs(*texts, ids=[*range(len(TEXTS)), None, 5]), bytes_file, cache, limit=100)
    expected = Counter(
        (i, len((t or "").encode()), n := library_count(bytes_file, t), n > 100)
        for i, t in zip([*range(len(TEXTS)), None, 5], texts)
    )
    assert Counter(map(tuple, found.collect())) == expected
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_only_misses_are_encoded(spark, docs, bytes_file):
    cache = new_path(spark, "cache")
    path = f"{cache}/tokenizer={tokens.file_digest(bytes_file)}"
    first = token_counts.count_tokens(docs("a b", "c", None, ""), bytes_file, cache)
    assert first.count() == 4
    assert token_counts.read_cache(spark, path).count() == 3  # null is the empty text
    # A stored count is believed, so a wrong one shows that it was used.
    token_counts.read_cache(spark, path).selectExpr("digest", "n_tokens + 100 AS n_tokens").write.parquet(path + "x")
    again = spark.read.schema(token_counts.SCHEMA).parquet(path + "x").collect()
    spark.createDataFrame(again, token_counts.SCHEMA).write.mode("overwrite").parquet(path)
    second = token_counts.count_tokens(docs("a b", "new text"), bytes_file, cache)
    counts = {r.doc_id: r.n_tokens for r in second.collect()}
    assert counts == {0: 102, 1: library_count(bytes_file, "new text")}
    assert token_counts.read_cache(spark, path).count() == 4


def test_count_tokens_of_nothing(spark, docs, bytes_file):
    empty = docs("a").limit(0)
    assert token_counts.count_tokens(empty, bytes_file, new_path(spark, "cache")).count() == 0


def test_pieces_cover_documents_and_sequences(docs, words_file):
    texts = TEXTS * 40
    rows = packing.pack(docs(*texts).repartition(3), words_file).collect()
    library = tokens.load(words_file)
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_document.keys() == set(range(len(texts)))
    for i, t in enumerate(texts):
        pieces = sorted(by_document[i], key=lambda r: r.start)
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(bytes(p.ids) for p in pieces) == ids
        assert zlib.crc32(b"".join(bytes(p.ids) for p in pieces)) == zlib.crc32(ids)
        assert all(p.doc_tokens == len(ids) // 4 and 4 * p.length == len(p.ids) for p in pieces)
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
    for pieces in by_sequence.values():
        pieces = sorted(pieces, key=lambda r: r.offset)
        size = sum(p.length for p in pieces)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert size <= 2048 and size & (size - 1) == 0  # no padding
        assert {p.sequence_length for p in pieces} == {size} and len({p.step_group for p in pieces}) == 1
    groups = Counter()
    for pieces in by_sequence.values():
        groups[pieces[0].step_group] += pieces[0].sequence_length
    assert max(groups.values()) <= 2 * packing.STEP_TOKENS


def test_packing_keeps_short_documents_whole():
    packer = packing.Packer()
    for k in range(2000):
        packer.add(k, 100 + k % 700)
    windows = [w for group in packer.flush(True) for w in group]
    pieces = Counter(document for w in windows for document, _, _ in w)
    assert sum(n == 1 for n in pieces.values()) > 0.6 * len(pieces)
    assert {sum(p[2] for p in w) for w in windows} >= {256, 512, 1024}


def test_packing_of_nothing(docs, words_file):
    assert packing.pack(docs("a").limit(0), words_file).count() == 0


def test_pack_null_and_repeated_keys(docs, words_file):
    rows = packing.pack(docs("a", "b", "c", "c", ids=[None, 1, 1, None]).coalesce(1), words_file).collect()
    assert Counter(r.doc_id for r in rows) >= Counter([None, 1, 1, None])
    assert sum(r.length for r in rows) == 8


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30) | SOME_TEXT, max_size=4), st.integers(0, 2**60))
def test_sampling_is_lossless_and_does_not_depend_on_the_batch(pieces_file, texts, key):
    vocabulary = piece_sampling.vocabulary(pieces_file, 1.0)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    together = piece_sampling.Sampler(vocabulary)(texts, [key + k for k in range(len(texts))])
    for k, t in enumerate(texts):
        (alone,) = piece_sampling.Sampler(vocabulary)([t], [key + k])
        assert alone.tolist() == together[k].tolist()
        assert b"".join(vocabulary.surface[i] for i in alone).decode() == t


def test_segmentations_are_drawn_by_their_weight(pieces_file):
    vocabulary = piece_sampling.vocabulary(pieces_file, 1.0)
    word, weights = "then", {}

    def walk(rest, ids, weight):
        if not rest:
            weights[tuple(ids)] = weight
        for n in range(1, len(rest) + 1):
            found = vocabulary.pieces.get(rest[:n])
            if found:
                walk(rest[n:], [*ids, found[0]], weight * found[1])

    walk(word, [], 1.0)
    n = 20000
    drawn = Counter(tuple(x.tolist()) for x in piece_sampling.Sampler(vocabulary)([word] * n, list(range(n))))
    total = sum(weights.values())
    for ids, weight in weights.items():
        p = weight / total
        assert abs(drawn[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_long_words_do_not_underflow(pieces_file):
    vocabulary = piece_sampling.vocabulary(pieces_file, 1.0)
    text = "qzxj" * 20000
    (ids,) = piece_sampling.Sampler(vocabulary)([text], [1])
    assert b"".join(vocabulary.surface[i] for i in ids).decode() == text


def test_encode_and_decode(docs, pieces_file):
    pieces = piece_sampling.encode(docs(*TEXTS, "a", "line\nend", ids=[*range(len(TEXTS)), None, 5]), pieces_file)
    rows = piece_sampling.decode(pieces, pieces_file).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.decoded == (r.text or "") for r in rows)
    five = [bytes(r.ids) for r in rows if r.doc_id == 5]
    assert len(five) == 2 and five[0] == five[1]
    assert piece_sampling.encode(docs("a").limit(0), pieces_file).count() == 0


def test_a_model_without_byte_pieces_is_refused(pieces_file, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError):
        piece_sampling.Vocabulary(pieces_file)


def test_strings_that_are_no_piece_are_rarely_searched(pieces_file, monkeypatch):
    words = piece_sampling.vocabulary(pieces_file, 1.0)
    pieces = [p for p in words.pieces if len(p) == 3][:500]
    pick = np.random.default_rng(2)
    strings = pieces + ["".join(map(chr, row)) for row in pick.integers(0x4000, 0x9000, (20_000, 3))]
    h = np.zeros(len(strings), np.uint64)
    for k in range(3):
        h = piece_sampling.mix(h * piece_sampling._BASE + np.array([ord(s[k]) for s in strings], np.uint64))
    searched, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda keys, v, *rest: searched.append(len(v)) or search(keys, v, *rest))
    place, ids, weights = words.look_up(3, h)
    expected = [(k, *words.pieces[s]) for k, s in enumerate(strings) if s in words.pieces]
    assert list(zip(place.tolist(), ids.tolist(), weights.tolist())) == expected
    assert sum(searched) < len(strings) // 5
