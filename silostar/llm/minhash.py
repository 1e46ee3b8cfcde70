"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has T coordinates. In each of the first T rounds every shingle falls into one hashed
bin with one hashed value; in the next T rounds every shingle falls into the bin of the round,
so that every coordinate fills. A coordinate keeps the least value of the first round that
reached it. As bins are dealt like balls, the part of equal coordinates of two sketches is
concentrated about the Jaccard similarity at least as well as for T independent minima.

Bands of coordinates give buckets. Links are only ever confirmed on the full shingle sets.
Since a class of near copies has far more links than it needs to hang together, links are
tried in rounds: each text first with one central text of its buckets, then with the most
similar text of its blocks that it does not yet hang together with, and at last all pairs of a bucket that
still lie in different components are compared where the bucket's sets are, so that only links
leave the task. So no link that joins components is left out, and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import discard, key_text, stored, typed
from silostar.llm.components import components

COORDINATES = 256
BANDS, ROWS = 32, 5  # a pair at 0.8 is missed by all bands once in 300,000 pairs
# Sketches that agree less than this are not verified: four deviations below 0.8.
LEAST_AGREEMENT = 0.7
# Members of a bucket that one task compares at once; larger buckets are cut into blocks.
BLOCK = 1024
# Texts that are verified against one central text in one run.
RUN = 512
# Rounds that try the best partner of each text before all remaining pairs are tried.
BEST_ROUNDS = 2
# Nodes whose best partners a task keeps before it hands them on.
HELD_NODES = 100_000
_MAX_WORDS = 1_000_000


class WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MAX_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, applied to each element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The set of shingle hashes, sorted. Words are cut at ASCII white space; only A-Z are
    lower-cased. A text of fewer words is one shingle, one without words is empty."""
    words = hashes.of((text or "").encode().lower().split())
    n = len(words) - width + 1
    if not len(words):
        return words
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), seed=len(words))], np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return np.unique(out)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of ``t`` 16-bit fingerprints per set. All sets go through the rounds together;
    those whose coordinates are filled drop out. Empty sets have zeros."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for k in range(2 * t):
        if not len(elements):
            break
        h = mix(elements + np.uint64((0xD1B54A32D192ED03 * (k + 1)) % 2**64))
        # The round goes before the hash, so that an earlier round always wins.
        value = (np.uint64(k) << np.uint64(54)) | (h >> np.uint64(10))
        place = (h & np.uint64(1023)) % np.uint64(t) if k < t else np.uint64(k - t)
        np.minimum.at(out, owner * t + place.astype(np.int64), value)
        full = (out.reshape(-1, t) != np.iinfo(np.uint64).max).all(1)
        keep = ~full[owner]
        elements, owner = elements[keep], owner[keep]
    out = mix(out).astype(np.uint16).reshape(-1, t)
    out[sizes == 0] = 0
    return out


def read_sets(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """key, n_shingles, node (128-bit digest of the set, null if empty), sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, width, hashes) for t in batch["text"]]
            yield pd.DataFrame({
                "key": batch["key"],
                "n_shingles": [len(s) for s in sets],
                "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sketch": [row.tobytes() for row in sketches(sets)],
            })

    schema = "key string, n_shingles long, node binary, sketch binary"
    return typed(df.select(key_text(key), F.col(text).alias("text")).mapInPandas(run, schema), df, key)


def bands(found: DataFrame) -> DataFrame:
    """bucket, node: a row per set and band."""
    bytes_ = 2 * ROWS
    keys = F.array(*(
        F.xxhash64(F.lit(b), F.substring("sketch", b * bytes_ + 1, bytes_)) for b in range(BANDS)
    ))
    return found.filter(F.col("node").isNotNull()).select("node", F.explode(keys).alias("bucket"))


def bucket_members(found: DataFrame) -> DataFrame:
    """bucket, node of all buckets with several sets. Copies of a set are one: they are
    combined in each task before they move."""
    rows = bands(found)
    start = F.xxhash64("node")
    several = (
        rows.groupBy("bucket").agg(F.min(start).alias("least"), F.max(start).alias("most"))
        .filter(F.col("least") != F.col("most")).select("bucket")
    )
    return rows.join(several, "bucket").distinct()


def node_sets(df: DataFrame, nodes: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """node, shingles (sorted 64-bit hashes) of the named nodes, one row each."""
    texts = nodes.join(
        df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key"
    ).select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for node, t in zip(batch["node"], batch["text"]):
                data = shingles(t, width, hashes).tobytes()
                if xxhash.xxh3_128_digest(data) == bytes(node):  # ids may repeat with other texts
                    out.append((node, data))
            yield pd.DataFrame(out, columns=["node", "shingles"])

    return texts.mapInPandas(run, "node binary, shingles binary").groupBy("node").agg(
        F.first("shingles").alias("shingles")
    )


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, which follow each other, as one frame."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        values = list(zip(*(batch[k] for k in keys)))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if i > start:
                    held.append(batch.iloc[start:i])
                if held:
                    yield pd.concat(held, ignore_index=True)
                held, start, last = [], i, value
        if len(batch) > start:
            held.append(batch.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b), those whose sets are at least so similar.

    ``a`` may stand in very many pairs: they are cut into runs, and its set goes to each run
    once, not to each pair.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("n_runs"))
    each = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("n_runs")).cast("int").alias("run")
    )
    hubs = each.select("a", "run").distinct().join(sets.withColumnRenamed("node", "a"), "a")
    others = each.join(sets.withColumnRenamed("node", "b"), "b")
    rows = hubs.select("a", "run", F.lit(None).cast("binary").alias("b"), "shingles").unionByName(
        others.select("a", "run", "b", "shingles")
    )
    percent = round(100 * similarity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for a, b, data in zip(batch["a"], batch["b"], batch["shingles"]):
                one = np.frombuffer(data, np.uint64)
                if b is None:
                    hub = one
                    continue
                at = np.minimum(np.searchsorted(hub, one), len(hub) - 1)
                both = int((hub[at] == one).sum())
                if 100 * both >= percent * (len(hub) + len(one) - both):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"], dtype=object)

    return (
        rows.repartition("a", "run")
        .sortWithinPartitions("a", "run", F.col("b").asc_nulls_first())
        .mapInPandas(run, "a binary, b binary")
    )


def central_pairs(members: DataFrame) -> DataFrame:
    """Each node with one centre: a, b, one row per node at most.

    A node weighs what its buckets hold together, so that the least changed of many copies
    weighs most. The centre of a bucket is its heaviest node, and a node takes the heaviest
    centre of its buckets.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    weights = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = members.join(weights, "node")
    centres = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("centre"))
    return (
        members.join(centres, "bucket")
        .filter(F.col("node") != F.col("centre.node"))
        .groupBy("node").agg(F.max("centre").alias("centre"))
        .select(F.col("centre.node").alias("a"), F.col("node").alias("b"))
    )


def open_members(members: DataFrame, labels: DataFrame, across: bool = True) -> DataFrame:
    """bucket, node, component, x, y: the members of buckets with several components. A
    bucket of more than BLOCK nodes is cut, in each bucket otherwise. Each two blocks x, y of
    it are a group or, if not ``across``, each block alone."""
    labelled = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    unfinished = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"),
             F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"))
        .filter(F.col("least") != F.col("most")).select("bucket", "n_blocks")
    )
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("n_blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    placed = labelled.join(unfinished, "bucket").withColumn("own", own)
    if not across:
        return placed.select("bucket", "node", "component", F.col("own").alias("x"), F.col("own").alias("y"))
    return (
        placed.select("bucket", "node", "component", "own", F.explode(others).alias("other"))
        .select("bucket", "node", "component",
                F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "node")


def _agreement(group: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Some rows at a time, how much the sketches of nodes in different components agree;
    0 within a component."""
    component = np.unique([bytes(c) for c in group["component"]], return_inverse=True)[1]
    rows = np.frombuffer(b"".join(group["sketch"]), np.uint16).reshape(len(group), -1)
    for at in range(0, len(group), 16):
        agree = (rows[at : at + 16, None, :] == rows[None, :, :]).mean(2)
        agree[component[at : at + 16, None] == component[None, :]] = 0
        yield at, agree


def best_pairs(open_: DataFrame, sketches_: DataFrame) -> DataFrame:
    """a, b, agreement: of each node b the two partners in other components whose sketches
    agree most, if they agree enough. A task hands on the best of all its groups, and a pair
    that shares several groups counts in the first of them, so that a node in many buckets
    does not give a row for each."""
    open_ = open_.withColumn("group", F.xxhash64("bucket", "x", "y"))
    groups = open_.groupBy("node").agg(F.collect_set("group").alias("groups"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bytes, list[tuple[float, bytes]]] = {}

        def found() -> pd.DataFrame:
            out = [(a, b, agreement) for b, partners in best.items() for agreement, a in partners]
            best.clear()
            return pd.DataFrame(out, columns=["a", "b", "agreement"])

        for group in runs(batches, ["bucket", "x", "y"]):
            nodes, here = [bytes(n) for n in group["node"]], group["group"].iloc[0]
            before = [frozenset(v for v in g if v < here) for g in group["groups"]]
            for at, agree in _agreement(group):
                j = np.argsort(-agree, 1, kind="stable")[:, :2]
                i = np.repeat(np.arange(len(agree)), j.shape[1])
                j = j.ravel()
                good = agree[i, j] >= LEAST_AGREEMENT
                for one, other in zip(i[good].tolist(), j[good].tolist()):
                    if not before[one + at].isdisjoint(before[other]):
                        continue
                    partners = best.setdefault(nodes[one + at], [])
                    entry = (float(agree[one, other]), nodes[other])
                    if entry not in partners:
                        best[nodes[one + at]] = sorted([*partners, entry], reverse=True)[:2]
            if len(best) > HELD_NODES:
                yield found()
        yield found()

    return _grouped(open_.join(sketches_, "node").join(groups, "node")).mapInPandas(
        run, "a binary, b binary, agreement double"
    )


def remaining_links(open_: DataFrame, sketches_: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b: links between components, enough to join all that a link joins.

    A first pass finds the nodes that have a partner in another component whose sketch agrees
    enough; a pair that shares several buckets counts in the first of them. The second pass
    has the full sets of these nodes, and compares each with all nodes of other components
    of its group. A set moves once per group, not per pair.
    """
    buckets = open_.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["bucket", "x", "y"]):
            bucket = group["bucket"].iloc[0]
            before = [frozenset(v for v in b if v < bucket) for b in group["buckets"]]
            some = np.zeros(len(group), bool)
            for at, agree in _agreement(group):
                for i, j in zip(*np.nonzero(agree >= LEAST_AGREEMENT)):
                    i += at
                    if not (some[i] and some[j]) and before[i].isdisjoint(before[j]):
                        some[i] = some[j] = True
            yield group.loc[some, ["bucket", "node", "component", "x", "y"]]

    picked = _grouped(open_.join(sketches_, "node").join(buckets, "node")).mapInPandas(
        pick, "bucket long, node binary, component binary, x int, y int"
    )
    percent = round(100 * similarity)

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["bucket", "x", "y"]):
            nodes = group["node"].to_numpy()
            label = np.unique([bytes(c) for c in group["component"]], return_inverse=True)[1]
            parts = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            sizes = np.array([len(p) for p in parts])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            values, codes = np.unique(np.concatenate(parts), return_inverse=True)
            has, out = np.zeros(len(values), np.int32), []
            for i, (start, size) in enumerate(zip(starts, sizes)):
                if (label == label[i]).all():
                    break
                own = codes[start : start + size]
                has[own] = 1
                both = np.add.reduceat(has[codes], starts)
                has[own] = 0
                linked = 100 * both >= percent * (size + sizes - both)
                # One link to each other component, which then is the same one.
                for other in np.unique(label[linked & (label != label[i])]):
                    j = np.nonzero(linked & (label == other))[0][0]
                    out.append((nodes[i], nodes[j]))
                    label[label == other] = label[i]
            yield pd.DataFrame(out, columns=["a", "b"], dtype=object)

    return _grouped(picked.join(sets, "node")).mapInPandas(link, "a binary, b binary")


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


def duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id, kept.

    component_id is the smallest key that the row's text is linked with, directly or through
    others; kept marks the rows whose key that is. Null and empty texts and texts without
    words are linked with nothing and kept. Rows with a null key are linked with nothing,
    have a null component_id and are kept, as no key could stand for them. Repeated rows
    share key and component; all of them are kept or none.
    """
    if similarity < 0.8:
        raise ValueError("bands and agreement are set for a similarity of 0.8 or more")
    found = stored(read_sets(df, key, text, width), "sketches")
    named = found.filter(F.col("node").isNotNull() & F.col("key").isNotNull())
    classes = named.groupBy("node").agg(F.min("key").alias("key"))
    members = stored(bucket_members(named), "buckets")
    nodes = members.select("node").distinct().join(classes, "node")
    sets = stored(node_sets(df, nodes, key, text, width), "sets")

    sketches_ = named.groupBy("node").agg(F.first("sketch").alias("sketch")).join(
        members.select("node").distinct(), "node", "left_semi"
    )
    # Every table of a round is written once and deleted after its last reader, so that plans
    # stay short and the disk holds one round.
    sketches_ = stored(sketches_, "bucket-sketches")
    pairs = stored(central_pairs(members), "pairs")
    links = stored(verify(pairs, sets, similarity), "links")
    tried = stored(_unordered(pairs), "tried")
    discard(pairs)
    labels = components(links)
    for _ in range(BEST_ROUNDS):
        best = best_pairs(open_members(members, labels, across=False), sketches_)
        fresh = best.join(
            tried, (F.least("a", "b") == F.col("low")) & (F.greatest("a", "b") == F.col("high")), "left_anti"
        ).groupBy("b").agg(F.max(F.struct("agreement", "a")).alias("best"))
        fresh = stored(fresh.select("best.a", "b"), "pairs")
        more = stored(links.unionByName(verify(fresh, sets, similarity)), "links")
        again = stored(tried.unionByName(_unordered(fresh)), "tried")
        discard(fresh, links, tried, labels)
        links, tried = more, again
        labels = components(links)
    last = stored(remaining_links(open_members(members, labels), sketches_, sets, similarity), "links")
    discard(members, sets, sketches_, tried, labels)
    labels = components(links.unionByName(last))
    discard(links, last)

    least = labels.join(classes, "node").groupBy("component").agg(F.min("key").alias("component_id"))
    groups = labels.join(least, "component").select("node", "component_id")
    classes = classes.join(groups, "node", "left").select(
        "node", F.coalesce("component_id", "key").alias("component_id")
    )
    result = stored(
        found.select("key", "n_shingles", "node")
        .join(classes, "node", "left")
        .select(
            F.col("key").alias(key), "n_shingles",
            F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))),
        "near-duplicates",
    )
    discard(found, labels)
    return result
