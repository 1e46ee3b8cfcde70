"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

Vectors of one label (and length) start at the root of each tree. A node is split at a random
direction, where its projections are sparsest, and vectors near the cut go to both sides, so
that a pair above the threshold is hardly ever parted; several trees with other directions
make it rarer still. Vectors are compared within leaves, in double precision, and a pair that
shares several leaves counts in the first of them only. So a leaf gives each vector's number
of links and a spanning forest of its links, never the pairs themselves.
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
from silostar.llm.minhash import runs

SIMILARITY = 0.98
TREES = 5
LEVELS = 32
# A node of at most so many vectors is a leaf. Leaves that no cut can part may be larger.
LEAF = 1024
# Vectors that one task compares at once; larger leaves are cut into blocks.
BLOCK = 2048
# A cut is made only if less than this part of a node lies near it.
MOST_SPILLED = 0.4
SEED = 20


def read_vectors(df: DataFrame, key: str, vector: str, label: str, trees: int, similarity: float) -> DataFrame:
    """key, node (128-bit digest of label and vector), root, data (float64), projections
    (float, per tree and level) and ``near``, the distance from a cut that goes to both sides.

    Null labels, null and zero vectors and vectors with components that are null or not
    finite have a null node.
    """
    cut = np.sqrt(2 - 2 * similarity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for name, x, of in zip(batch["key"], batch["vector"], batch["label"]):
                x = None if x is None or of is None else np.array([np.nan if v is None else v for v in x], float)
                if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                    out.append((name, None, None, None, None, None))
                    continue
                if len(x) not in directions:
                    r = np.random.default_rng([SEED, len(x)]).standard_normal((len(x), trees * LEVELS))
                    directions[len(x)] = r / np.linalg.norm(r, axis=0)
                # Scaled first, so that no square overflows or vanishes.
                unit = x / np.abs(x).max()
                unit /= np.linalg.norm(unit)
                root = f"{of}\n{len(x)}".encode()
                node = xxhash.xxh3_128_digest(root + b"\n" + x.tobytes())
                projected = (unit @ directions[len(x)]).astype(np.float32)
                out.append((name, node, xxhash.xxh3_64_intdigest(root) >> 1, unit.tobytes(),
                            projected.reshape(trees, LEVELS).tolist(), cut / np.sqrt(len(x))))
            frame = pd.DataFrame(out, columns=["key", "node", "root", "data", "projections", "near"], dtype=object)
            frame["key"] = batch["key"].array
            yield frame

    rows = df.select(key_text(key), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label"))
    found = rows.mapInPandas(
        run, "key string, node binary, root long, data binary, projections array<array<float>>, near double"
    )
    return typed(found, df, key)


def leaves(classes: DataFrame, trees: int, leaf: int) -> DataFrame:
    """leaf, node: every vector in at least one leaf of every tree.

    A level reads the counts and quantiles of its nodes from a grouping, which is small, and
    hands on the vectors of split nodes; the others have reached their leaf.
    """
    rows = stored(
        classes.select(
            "node", "near", F.posexplode("projections").alias("tree", "at"), "root"
        ).select("node", "near", "at", F.xxhash64("root", "tree").alias("leaf")),
        "tree-level",
    )
    done: list[DataFrame] = []
    steps = [k / 20 for k in range(1, 20)]
    for level in range(LEVELS):
        value = F.get("at", F.lit(level))
        stats = rows.groupBy("leaf").agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(value, steps, 400).alias("q"), F.max("near").alias("near")
        ).filter(F.col("n") > leaf)
        # A tenth of the node lies between the quantiles beside a cut; take the widest place
        # of the middle half.
        places = F.array(*(
            F.struct((F.col("q")[i + 1] - F.col("q")[i - 1]).alias("gap"), F.col("q")[i].alias("cut"))
            for i in range(4, 15)
        ))
        cuts = stats.withColumn("best", F.array_max(places)).filter(
            F.col("best.gap") * MOST_SPILLED > 0.1 * 2 * F.col("near")
        ).select("leaf", F.col("best.cut").alias("cut"))
        cuts = stored(cuts, "tree-cuts")
        if cuts.isEmpty():
            break
        joined = rows.join(cuts, "leaf", "left")
        done.append(joined.filter(F.col("cut").isNull()).select("leaf", "node"))
        away = value - F.col("cut")
        sides = F.array_compact(F.array(
            F.when(away <= F.col("near"), F.lit(0)), F.when(away >= -F.col("near"), F.lit(1))
        ))
        rows = stored(
            joined.filter(F.col("cut").isNotNull())
            .select("node", "near", "at", "leaf", F.explode(sides).alias("side"))
            .select("node", "near", "at", F.xxhash64("leaf", F.lit(level), "side").alias("leaf")),
            "tree-level",
        )
    out = rows.select("leaf", "node")
    for part in done:
        out = out.unionByName(part)
    return stored(out, "leaves")


def _spanning(links: np.ndarray) -> np.ndarray:
    """For each row the first row of its component."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(1, initial=len(links))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(found: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """node, other, n: per leaf, the links counted for a vector (copies included) and one
    vector that it hangs together with (null for the first of each component)."""
    sizes = found.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"),
                                      F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = found.join(sizes, "leaf")
    of_node = shared.groupBy("node").agg(F.collect_list(F.struct("leaf", "n_blocks")).alias("leaves"))
    rows = (
        classes.select("node", "copies", "data").join(of_node, "node")
        .select("node", "copies", "data", F.col("leaves.leaf").alias("all"), F.explode("leaves").alias("l"))
        .select("node", "copies", "data", "all", F.col("l.leaf").alias("leaf"), F.col("l.n_blocks").alias("n_blocks"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("node", "copies", "data", "all", "leaf", "own",
                F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["leaf", "x", "y"]):
            m, leaf = len(group), group["leaf"].iloc[0]
            unit = np.frombuffer(b"".join(group["data"]), float).reshape(m, -1)
            links = unit @ unit.T >= similarity
            np.fill_diagonal(links, False)
            if group["x"].iloc[0] != group["y"].iloc[0]:  # pairs of one block have their own group
                own = group["own"].to_numpy()
                links &= own[:, None] != own[None, :]
            if not links.any():
                continue
            i, j = np.nonzero(links)
            before = [frozenset(v for v in all_ if v < leaf) for all_ in group["all"]]
            earlier = {v: k for k, v in enumerate(set().union(*(before[k] for k in set(i))))}
            if earlier:  # a pair counts in its first common leaf
                member = np.zeros((m, len(earlier)), np.float32)
                for k in set(i):
                    member[k, [earlier[v] for v in before[k]]] = 1
                links &= (member @ member.T) == 0
            n = links @ group["copies"].to_numpy(float)
            first = _spanning(links)
            some = np.nonzero(n)[0]
            nodes = group["node"].to_numpy()
            other = np.where(first == np.arange(m), None, nodes[first])
            yield pd.DataFrame({"node": nodes[some], "other": other[some], "n": n[some].astype(np.int64)})

    return (
        rows.repartition("leaf", "x", "y").sortWithinPartitions("leaf", "x", "y", "node")
        .mapInPandas(run, "node binary, other binary, n long")
    )


def duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    similarity: float = SIMILARITY, trees: int = TREES, leaf: int = LEAF,
) -> DataFrame:
    """One row per row of ``df``: key, n_links, component_id, kept.

    Only vectors of equal labels and lengths are compared. Unusable vectors (see
    ``read_vectors``) have no links and are their own component. Equal vectors are one class
    with a number of copies, and link with each other. Rows with a null key count as
    vectors, but name no component: without another key theirs is null, and they are kept.
    Repeated rows are vectors of their own with a common key; all of them are kept or none.
    """
    found = stored(read_vectors(df, key, vector, label, trees, similarity), "vectors")
    classes = stored(
        found.filter(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.first("data").alias("data"),
            F.first("root").alias("root"), F.first("projections").alias("projections"), F.first("near").alias("near"),
        ),
        "vector-classes",
    )
    linked = stored(compare(leaves(classes, trees, leaf), classes, similarity), "vector-links")
    counts = linked.groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(linked.filter(F.col("other").isNotNull()), "node", "other")
    names = classes.select("node", "key")
    least = labels.join(names, "node").groupBy("component").agg(F.min("key").alias("component_id"))
    groups = labels.join(least, "component").select("node", "component_id")
    about = (
        classes.select("node", "copies", F.col("key").alias("first"))
        .join(groups, "node", "left").join(counts, "node", "left")
        .select(
            "node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        )
    )
    return (
        found.select("key", "node").join(stored(about, "vector-groups"), "node", "left")
        .select(
            F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col(key).isNull()))
    )
