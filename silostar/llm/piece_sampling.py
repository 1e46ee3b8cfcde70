"""Sampled segmentations over the piece lattice, and their lossless decoding.

Forward filtering sums the weights of all segmentations of each prefix; backward sampling then
draws pieces from the end, each in proportion to the weight of all segmentations that end in
it. Draws are hashes of the row's key and the place in its text, so that a row has the same
segmentation in whatever order or batch it comes.

Where no piece crosses the start of a word the lattice falls apart into words. Each worker
filters a word once and then draws for all its occurrences of a batch at the same time.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import key_text, typed
from silostar.llm.minhash import mix

# Power of the weights: 0 draws evenly among segmentations, large values the best one.
ALPHA = 1.0
SEED = 7
# Words whose lattices a worker keeps, and their edges, before it starts anew.
MAX_WORDS = 150_000
MAX_EDGES = 3_000_000
# Longer words are filtered anew each time they occur.
LONGEST_KEPT = 200
# Words up to this length, of characters that are pieces, are filtered many at a time.
SHORT = 24
_AT_ONCE = 8192
_BITS = 32  # of a length
_FIRST_BITS = 18  # of a hash, by which most strings that are no piece are told
MARK = "▁"  # stands for a space in pieces
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by their text (spaces for marks), their weights, and the bytes of each id.

    Scores of merge models are ranks, which stand for no probability: their weight is one
    over the rank, as frequencies of words go. Other scores are log probabilities.
    """

    def __init__(self, model: str, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (
            sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        )]
        score = {i: sp.get_score(i) for i in plain}
        ranks = all(float(s).is_integer() for s in score.values())
        weight = {i: alpha * (-np.log(1 - s) if ranks else s) for i, s in score.items()}
        self.pieces = {sp.id_to_piece(i).replace(MARK, " "): (i, float(np.exp(weight[i]))) for i in plain}
        self.bytes = [-1] * 256
        self.surface: list[bytes] = [b""] * size
        for piece, (i, _) in self.pieces.items():
            self.surface[i] = piece.encode()
        for i in range(size):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[1:-1], 16)
                self.bytes[value], self.surface[i] = i, bytes([value])
        if -1 in self.bytes:
            raise ValueError("the model has no pieces for bytes: it cannot encode all texts")
        self.edges = self.pieces | {chr(0xD800 + v): (i, 1.0) for v, i in enumerate(self.bytes)}
        self.longest = max(map(len, self.pieces))
        self.by_length = [self._hashed(n) for n in range(1, self.longest + 1)]
        self.by_word = not any(" " in p.lstrip(" ") for p in self.pieces)
        lone = not any("\n" in p and len(p) > 1 for p in self.pieces)
        # Words with the spaces before them; line ends apart, if no longer piece has them.
        self.words = re.compile(r" *[^ \n]+|\n| +" if lone else r" *[^ ]+| +")

    def _hashed(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the pieces of one length, with their ids and weights, and which
        first bits of a hash any of them has."""
        pieces = [p for p in self.pieces if len(p) == length] or ["\0" * length]
        codes = np.array([[ord(c) for c in p] for p in pieces], np.uint64)
        h = np.zeros(len(pieces), np.uint64)
        for k in range(length):
            h = mix(h * _BASE + codes[:, k])
        order = np.argsort(h)
        found = [self.pieces.get(pieces[k], (-1, 0.0)) for k in order]
        some = np.zeros(1 << _FIRST_BITS, bool)
        some[h >> np.uint64(64 - _FIRST_BITS)] = True
        return h[order], np.array([i for i, _ in found], np.int32), np.array([w for _, w in found]), some

    def look_up(self, length: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of hashes of strings of one length: the flat places of those that are pieces, with
        their ids and weights."""
        keys, ids, weights, some = self.by_length[length - 1]
        flat = h.ravel()
        place = np.nonzero(some[flat >> np.uint64(64 - _FIRST_BITS)])[0]
        flat = flat[place]
        at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
        hit = (keys[at] == flat) & (ids[at] >= 0)
        return place[hit], ids[at[hit]], weights[at[hit]]

    def split(self, text: str) -> list[str]:
        return self.words.findall(text) if self.by_word else [text] if text else []

    def units(self, word: str) -> list[str]:
        """The characters of a word; those without a piece as their bytes, each written as
        a character of the range that no text can hold."""
        if self.pieces.keys() >= set(word):
            return list(word)
        return [u for c in word for u in (
            [c] if c in self.pieces else [chr(0xD800 + byte) for byte in c.encode()]
        )]


@functools.cache
def vocabulary(model: str, alpha: float) -> Vocabulary:
    return Vocabulary(model, alpha)


class Sampler:
    """Filtered lattices of words as flat arrays: a state per place, its edges next to each
    other with running probabilities, shifted by the state's number."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}  # the state of a word's start, and its length
        self.states = self.n_edges = 0
        self.edge = np.zeros(1 << 16, np.int64)  # the first edge of each state
        self.reach, self.start, self.id = np.zeros(1 << 16), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)

    def _learn(self, word: str) -> int:
        """The state of the word's start, shifted, and its number of places."""
        units = self.vocabulary.units(word)
        whole, longest, get = "".join(units), self.vocabulary.longest, self.vocabulary.edges.get
        first, sums = self.states, [1.0]
        reach, start, ids, states = [], [], [], []
        for end in range(1, len(units) + 1):
            total, shares, state = 0.0, [], first + end
            for begin in range(max(0, end - longest), end):
                found = get(whole[begin:end])
                if found:
                    total += sums[begin] * found[1]
                    shares.append(total)
                    start.append(begin - end)
                    ids.append(found[0])
            reach += [state + share / total for share in shares]
            states += [state] * len(shares)
            reach[-1] = state + 1.0
            sums.append(total)
            if total < 1e-150:  # only ratios within the longest piece count
                for k in range(max(0, end + 1 - longest), end + 1):
                    sums[k] *= 1e150
        self.states = first + len(units) + 1
        self._add(np.array(states), reach, start, ids)
        return first << _BITS | len(units)

    def _add(self, states: np.ndarray, reach, start, ids) -> None:
        """Edges in the order of their states."""
        while self.states > len(self.edge):
            self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
        begins = np.nonzero(np.append(True, states[1:] != states[:-1]))[0]
        self.edge[states[begins]] = self.n_edges + begins
        need = self.n_edges + len(reach)
        while need > len(self.reach):
            self.reach, self.start, self.id = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.reach, self.start, self.id)
            )
        part = slice(self.n_edges, need)
        self.reach[part], self.start[part], self.id[part] = reach, start, ids
        self.n_edges = need

    def _learn_short(self, words: list[str]) -> None:
        """The same for many short words at once: a row per word, a column per place."""
        n, longest = len(words), self.vocabulary.longest
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        padded = "".join(w.ljust(width, "\0") for w in words)  # no piece holds the filling
        codes = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(n, width).T.astype(np.uint64)
        longest = min(longest, width)
        hits, weights, h = [], [], np.zeros((width, n), np.uint64)
        for length in range(1, longest + 1):
            h = mix(h[: width - length + 1] * _BASE + codes[length - 1 :])
            place, ids, weight = self.vocabulary.look_up(length, h)
            hits.append((place, ids))
            weights.append(np.zeros(h.shape))
            weights[-1].ravel()[place] = weight
        first = self.states + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        sums, running = np.zeros((width + 1, n)), np.zeros((longest, width + 1, n))
        sums[0] = 1.0
        for end in range(1, width + 1):
            for k in range(min(longest, end), 0, -1):  # in the order of their start
                sums[end] += sums[end - k] * weights[k - 1][end - k]
                running[k - 1, end] = sums[end]
        parts = []
        for k in range(longest, 0, -1):
            place, ids = hits[k - 1]
            begin, row = place // n, place % n
            end = begin + k
            state = first[row] + end
            share = running[k - 1, end, row] / sums[end, row]
            parts.append((state, state + share, np.full(len(row), -k), ids))
        state, reach, start, found = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(state, kind="stable")
        state, reach = state[order], reach[order]
        last = np.append(state[1:] != state[:-1], True)
        reach[last] = state[last] + 1.0
        self.states = int(first[-1] + sizes[-1] + 1)
        self._add(state, reach, start[order], found[order])
        self.known.update(zip(words, (first << _BITS | sizes).tolist()))

    def __call__(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of each text, drawn by its key."""
        if len(self.known) > MAX_WORDS or self.n_edges > MAX_EDGES:
            self._clear()
        split = [self.vocabulary.split(t) for t in texts]
        known = self.known
        once: dict[str, int] = {}
        single, short = self.vocabulary.pieces.keys(), []
        for word in set().union(*split):
            if word not in known:
                if len(word) <= SHORT and single >= set(word):
                    short.append(word)
                else:
                    (known if len(word) <= LONGEST_KEPT else once)[word] = self._learn(word)
        short.sort(key=len)  # words of about one length fill a table
        for k in range(0, len(short), _AT_ONCE):
            self._learn_short(short[k : k + _AT_ONCE])
        look = known if not once else known | once
        counts = [len(w) for w in split]
        found = np.fromiter(map(look.__getitem__, chain.from_iterable(split)), np.int64, sum(counts))
        first, length = found >> _BITS, found & ((1 << _BITS) - 1)
        text = np.repeat(np.arange(len(texts)), counts)
        before = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
        # The place of a word in its own text, not in the batch.
        begins = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        offset = before - (before[np.minimum(begins, max(0, len(before) - 1))][text] if len(before) else 0)
        key = np.array(keys, np.uint64)[text]

        at, which = length.copy(), np.arange(len(length))
        ends, drawn = [], []
        while len(which):
            here = at[which]
            place = (offset[which] + here).astype(np.uint64)
            u = (mix(key[which] + place * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(12)) * 2.0**-52
            state = first[which] + here
            edge, target = self.edge[state], state + u
            below = np.nonzero(self.reach[edge] <= target)[0]
            while len(below):  # most places have one edge or two
                edge[below] += 1
                below = below[self.reach[edge[below]] <= target[below]]
            ends.append(before[which] + here)
            drawn.append(self.id[edge])
            at[which] = here + self.start[edge]
            which = which[at[which] > 0]
        if not drawn:
            return [np.zeros(0, np.int32) for _ in texts]
        ends, drawn = np.concatenate(ends), np.concatenate(drawn)
        order = np.argsort(ends, kind="stable")
        ends, drawn = ends[order], drawn[order]
        stops = np.concatenate([before[begins[1:][begins[1:] < len(before)]],
                                np.full((begins[1:] >= len(before)).sum(), ends[-1])])
        return np.split(drawn, np.searchsorted(ends, stops, "right"))


def encode(
    df: DataFrame, model: str, key: str = "doc_id", text: str = "text", alpha: float = ALPHA, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``df``: key, text, ids (little-endian unsigned 32-bit), n_pieces,
    lossless (the pieces give the text back).

    No shuffle. The text is taken as it is: no character is normalised and no space added.
    Null and empty texts have no pieces. Rows of equal key and text have the same ids; null
    keys are one key. Long texts are filtered word by word.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model, alpha)
        sampler, surface = Sampler(words), words.surface
        for batch in batches:
            keys = [xxhash.xxh3_64_intdigest(str(k).encode(), seed) for k in batch["key"]]
            texts = [t or "" for t in batch["text"]]
            ids = sampler(texts, keys)
            again = [b"".join(map(surface.__getitem__, x.tolist())) == t.encode() for x, t in zip(ids, texts)]
            yield pd.DataFrame({
                "key": batch["key"], "text": batch["text"],
                "ids": [x.astype("<u4").tobytes() for x in ids], "n_pieces": [len(x) for x in ids],
                "lossless": again,
            })

    pieces = df.select(key_text(key), F.col(text).alias("text")).mapInPandas(
        run, "key string, text string, ids binary, n_pieces long, lossless boolean"
    )
    return typed(pieces, df, key).withColumnRenamed("key", key)


def decode(df: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; null for null."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        surface = vocabulary(model, ALPHA).surface
        return pd.Series([
            None if x is None else b"".join(map(surface.__getitem__, np.frombuffer(x, "<u4").tolist())).decode()
            for x in column
        ], dtype=object)

    return df.withColumn(into, run(F.col(ids)))
