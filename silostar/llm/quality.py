"""Quality rules: fixed rules on words, then a calibrated logistic regression on hashed n-grams.

The model is fitted on a bounded sample of labelled rows: word unigrams and bigrams and
character trigrams are hashed into two tables of weights, a text's features being the shares
of its n-grams. Scores of a held-out part are calibrated to probabilities (Platt), and every
text is scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import key_text, typed
from silostar.llm.minhash import WordHashes, mix

BITS = 13  # of each table of weights
# Labelled rows that the model sees at most, chosen by the hash of their key.
SAMPLE = 4000
# A text is kept from this probability of being good on.
KEEP_FROM = 0.3
# Fixed rules.
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"


def base_figures(text: str | None, hashes: WordHashes) -> tuple[tuple, np.ndarray]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the words' hashes."""
    text = text or ""
    data = text.encode()
    words = hashes.of(data.split())
    lines = Counter(line for line in data.split(b"\n") if line.strip(_SPACES))
    n = len(words) - WINDOW + 1
    repeated = 0
    if n > 1:
        windows = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            windows = mix(windows * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        again = counts[which] > 1
        if again.any():
            covered = np.zeros(len(words), bool)
            for k in range(WINDOW):
                covered[k : k + n] |= again
            repeated = int(covered.sum())
    return (
        len(words),
        len(text) - sum(data.count(c) for c in _SPACES),
        sum(data.count(c) for c in SYMBOLS),
        sum(lines.values()) - len(lines),
        repeated,
    ), words


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def feature_buckets(text: str | None, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the word n-grams and of the character n-grams, with repetition."""
    mask = np.uint64((1 << BITS) - 1)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    grams = np.concatenate([words & mask, pairs & mask])
    codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
    chars = mix((codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:]) & mask
    return grams.astype(np.int64), chars.astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weights of the two tables, their bias, and the calibration of the margin."""

    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, text: str | None, words: np.ndarray) -> float:
        grams, chars = feature_buckets(text, words)
        margin = self.bias
        margin += self.words[grams].mean() if len(grams) else 0.0
        margin += self.chars[chars].mean() if len(chars) else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def _descend(x: tuple[np.ndarray, np.ndarray, np.ndarray], y: np.ndarray, size: int, steps: int, rate: float, decay: float):
    """Logistic regression by Adam on sparse rows (row, column, value); ``size`` weights and
    a bias."""
    row, column, value = x
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(row, w[column] * value, len(y)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y) / max(1, len(y))
        g = np.append(np.bincount(column, error[row] * value, size) + decay * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w


def train(y: np.ndarray, lengths: np.ndarray, columns: np.ndarray, shares: np.ndarray, seed: int = 7) -> Model:
    """From rows of shares, one after the other; word columns come before character columns.

    Four fifths fit the weights and the rest the calibration. With one label only, or no
    rows, every text gets that label's probability (good without rows).
    """
    size = 1 << BITS
    if len(set(y)) < 2:
        sure = 20.0 if not len(y) or y[0] == 1 else -20.0
        return Model(np.zeros(size), np.zeros(size), 0.0, 1.0, sure)
    y = y.astype(float)
    place = np.random.default_rng(seed).permutation(len(y))
    fit, held = place < len(y) - len(y) // 5, place >= len(y) - len(y) // 5
    row = np.repeat(np.arange(len(y)), lengths)

    def sparse(which: np.ndarray):
        own = which[row]
        return (np.cumsum(which) - 1)[row[own]], columns[own], shares[own]

    w = _descend(sparse(fit), y[fit], 2 * size, steps=150, rate=1.0, decay=1e-6)
    part, column, value = sparse(held)
    margin = np.bincount(part, w[column] * value, int(held.sum())) + w[-1]
    # Platt's smoothed targets keep the slope finite where the held-out part is separated.
    good, bad = y[held].sum(), (1 - y[held]).sum()
    target = np.where(y[held] == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(1.0, float(np.abs(margin).max(initial=0)))
    ones = (np.arange(len(margin)), np.zeros(len(margin), np.int64), margin / scale)
    a = _descend(ones, target, 1, steps=2000, rate=0.05, decay=0.0)
    return Model(w[:size], w[size : 2 * size], float(w[-1]), float(a[0]) / scale, float(a[1]))


def sample_features(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """key, columns, shares, label of at most ``sample`` labelled texts.

    The keys with the lowest hashes are taken, so that the choice depends on no order of
    rows. Null labels, other labels than 0 and 1 and null keys are left out; a key that is
    labelled more than once counts as good only if all its labels do, and of several texts
    of a key the least is taken.
    """
    chosen = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("key").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(sample)
    )
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    joined = (
        texts.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
        .select(key_text("key"), "text", "label")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for name, text_, y in zip(batch["key"], batch["text"], batch["label"]):
                _, words = base_figures(text_, hashes)
                columns, shares = [], []
                for offset, buckets in zip((0, 1 << BITS), feature_buckets(text_, words)):
                    found, counts = np.unique(buckets, return_counts=True)
                    columns += (found + offset).tolist()
                    shares += (counts / max(1, len(buckets))).tolist()
                out.append((name, columns, shares, y))
            yield pd.DataFrame(out, columns=["key", "columns", "shares", "label"])

    features = joined.mapInPandas(run, "key string, columns array<int>, shares array<float>, label int")
    return typed(features, df, key)


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """One task holds the sample's features, at most ``sample`` rows of 2^14 shares; the
    driver gets the weights."""
    names = ("words", "chars", "bias", "slope", "shift")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if found is None or not found.num_rows:
            model = train(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        else:
            found = found.sort_by([("key", "ascending")]).combine_chunks()
            lengths = found["columns"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            flat = lambda name: found[name].combine_chunks().flatten().to_numpy()
            model = train(found["label"].to_numpy(), lengths, flat("columns"), flat("shares"))
        values = [model.words.tobytes(), model.chars.tobytes(), model.bias, model.slope, model.shift]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=list(names))

    features = sample_features(df, labels, key, text, label, sample).repartition(1)
    # An empty sample has no task with rows; then there is no row either.
    row = features.mapInArrow(run, "words binary, chars binary, bias double, slope double, shift double").first()
    if row is None:
        return train(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    return Model(np.frombuffer(row.words), np.frombuffer(row.chars), row.bias, row.slope, row.shift)


def judge(
    df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM
) -> DataFrame:
    """One row per row of ``df``: key, the base figures, base_failed, probability, kept.

    No shuffle. Null texts are empty, and fail by their number of words. Null keys and
    repeated rows pass through.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, fitted = WordHashes(), shared.value
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for batch in batches:
            rows = []
            for text_ in batch["text"]:
                figures, words = base_figures(text_, hashes)
                failed = base_failed(figures[0], figures[4])
                p = fitted.probability(text_, words)
                rows.append((*figures, failed, p, not failed and p >= keep_from))
            out = pd.DataFrame(rows, columns=[*names, "base_failed", "probability", "kept"])
            out.insert(0, "key", batch["key"].array)
            yield out

    judged = df.select(key_text(key), F.col(text).alias("text")).mapInPandas(
        run, "key string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, probability double, kept boolean"
    )
    return typed(judged, df, key).withColumnRenamed("key", key)


def filter_rows(
    df: DataFrame, model: Model, text: str = "text", keep_from: float = KEEP_FROM
) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with all their columns as they are. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, fitted = WordHashes(), shared.value
        for batch in batches:
            keep = []
            for text_ in batch.column(batch.schema.get_field_index(text)).to_pylist():
                figures, words = base_figures(text_, hashes)
                failed = base_failed(figures[0], figures[4])
                keep.append(not failed and fitted.probability(text_, words) >= keep_from)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
