"""The trie of shared beginnings of conversations, screened by a count-min sketch.

Every turn becomes a digest before it moves, and every prefix of a conversation the digest of
the chain up to it. All prefixes are counted in a count-min sketch: one of its estimates is
never too low, so an estimate of one proves that no other conversation has this prefix, nor
any longer one. The nodes of such tails are emitted by the task that has the row. Only
prefixes that may be shared are shuffled, and grouped exactly, so that a wrong estimate costs
time, not results.

Sums over subtrees need no walk through the levels. A node belongs to its smallest member, and
a member that is smallest at some depth is so at all deeper ones. So each conversation owns
the end of its own path, and the sum over a subtree is, over the members of its top, the sum
of what each one owns from that depth on: one pass backwards through a conversation and one
grouping by prefix.

Groups may be hot: prefixes are combined within a task before they move, nodes with very many
members are looked up in a broadcast table of these nodes alone (as many as rows over
``HOT_MEMBERS`` at most, and checked by Spark for size), and ids are hashed as they stream by.

Rows: turns are ordered by number, nulls first, then by role and by the SHA-256 of the text;
repeated rows are turns of their own. Null roles and texts are empty. Rows without a
conversation id belong to no conversation and are left out. An empty table has no node, not
even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silostar.llm.common import stored

STRIDE = 20  # conversations whose ids agree up to this share their first one's beginning
MOST_HEADS = 3
# The sketch: rows, and the columns of each, a power of two between these bounds and at least
# four times the prefixes. At the most it takes 32 MB to broadcast, a bit per cell, and 256 MB in
# a task that counts; with more prefixes than columns fewer tails are proved, and more shuffled.
SKETCH_ROWS = 4
LEAST_COLUMNS, MOST_COLUMNS = 1 << 14, 1 << 26
BLOCK_CELLS = 1 << 16
HOT_MEMBERS = 1_000
ROOT = bytes(16)

_PREFIX = "conversation bigint, depth int, prefix binary, parent binary, words int, is_last boolean"


def rebuilt(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """conversation, depth (from 1), digest, words of every rebuilt turn, and one row with
    depth 0 per conversation, whether it has turns or not."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = df.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("bigint").alias("conversation"), F.col(turn).alias("turn"),
        role_.alias("role"), F.unhex(F.sha2(text_, 256)).alias("text_digest"),
        F.regexp_count(text_, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    place = Window.partitionBy("conversation").orderBy(F.col("turn").asc_nulls_first(), "role", "text_digest")
    numbered = rows.withColumn("depth", F.row_number().over(place)).select(
        "conversation", "depth", "words",
        F.unhex(F.sha2(F.concat(F.col("text_digest"), F.encode("role", "utf-8")), 256)).alias("digest"),
    )
    numbered = stored(numbered, "turns")
    shared = F.col("conversation") % STRIDE != 0
    n_heads = F.when(shared, F.crc32(F.col("conversation").cast("string")) % (MOST_HEADS + 1)).otherwise(0)
    names = numbered.select("conversation").distinct().withColumn("n_heads", n_heads.cast("int"))
    heads = numbered.filter(~shared & (F.col("depth") <= MOST_HEADS))
    lengths = heads.groupBy("conversation").agg(F.max("depth").alias("length"))

    base = (F.col("conversation") - F.col("conversation") % STRIDE).alias("base")
    borrowing = names.filter("n_heads > 0").select("conversation", "n_heads", base)
    taken = (
        borrowing.join(heads.withColumnRenamed("conversation", "base"), "base")
        .filter("depth <= n_heads")
        .select("conversation", "depth", "digest", "words")
    )
    # A conversation's own turns go on after the turns that its base does have.
    moved = borrowing.join(lengths.withColumnRenamed("conversation", "base"), "base", "left").select(
        "conversation", "n_heads", F.least("n_heads", F.coalesce("length", F.lit(0))).alias("n_taken")
    )
    skip = F.coalesce("n_heads", F.lit(0))
    own = (
        numbered.join(moved, "conversation", "left")
        .filter(F.col("depth") > skip)
        .select(
            "conversation", (F.col("depth") - skip + F.coalesce("n_taken", F.lit(0))).alias("depth"),
            "digest", "words",
        )
    )
    tops = names.select(
        "conversation", F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("words")
    )
    return own.unionByName(taken).unionByName(tops)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and depth to their prefixes: each digest covers the one
    before it. A row is held back until the next one shows whether it is the last."""
    names = [f.split()[0] for f in _PREFIX.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.bool_()]
    held, out = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conversation", "depth", "digest", "words")]
        for key, depth, digest, words in zip(*columns):
            if held is not None:
                out.append((*held, key != held[0]))
            if depth == 0:
                held = (key, 0, ROOT, None, 0)
            else:
                before = held[2]
                held = (key, depth, hashlib.blake2b(before + digest, digest_size=16).digest(), before, words)
        yield _batch(out, names, types)
        out = []
    if held is not None:
        yield _batch([(*held, True)], names, types)


def prefixes(turns: DataFrame) -> DataFrame:
    """conversation, depth, prefix, parent, words, is_last, for all depths from 0."""
    # Dealt by a hash of the id: where all parts of the union are placed by the id itself, Spark
    # would leave the exchange out, and then merge small partitions of each part on its own.
    ordered = turns.repartition(F.xxhash64("conversation")).sortWithinPartitions("conversation", "depth")
    return ordered.mapInArrow(_chain, _PREFIX)


def _cells(digests: pa.Array, columns: int) -> np.ndarray:
    """The cell of each digest in each row of the sketch."""
    halves = np.frombuffer(b"".join(digests.to_pylist()), dtype="<u8").reshape(-1, 2)
    at = np.arange(SKETCH_ROWS, dtype=np.uint64)[:, None]
    return (halves[:, 0] + at * (halves[:, 1] | np.uint64(1))) & np.uint64(columns - 1)


def _pack(counts: np.ndarray) -> bytes:
    """Counts of 0, 1 and 2 for more, as compressed bits."""
    return zlib.compress(np.packbits(counts > 0).tobytes() + np.packbits(counts > 1).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(zlib.decompress(data), dtype=np.uint8))
    return bits[: len(bits) // 2] + bits[len(bits) // 2 :]


def sketch(rows: DataFrame, columns: int) -> np.ndarray:
    """A bit per cell: set if the cell counts two prefixes or more. Each task counts in a
    sketch of its own, blocks of cells of all tasks are added up by Spark, and only the
    final bits, ``SKETCH_ROWS`` times ``columns``, come to the driver."""
    blocks = max(1, SKETCH_ROWS * columns // BLOCK_CELLS)
    schema = "block int, counts binary"
    types = ["block", "counts"], [pa.int32(), pa.binary()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(SKETCH_ROWS * columns, dtype=np.uint8)
        offsets = (np.arange(SKETCH_ROWS, dtype=np.uint64) * np.uint64(columns))[:, None]
        for batch in batches:
            if batch.num_rows:
                cells, times = np.unique((_cells(batch.column(0), columns) + offsets).ravel(), return_counts=True)
                own[cells] = np.minimum(own[cells] + np.minimum(times, 2), 2)
        for block, part in enumerate(np.split(own, blocks)):
            if part.any():
                yield _batch([(block, _pack(part))], *types)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            for at, data in zip(*(c.to_pylist() for c in batch.columns)):
                counts = _unpack(data)
                if at != block and block is not None:
                    yield _batch([(block, np.packbits(total > 1).tobytes())], *types)
                total = counts if at != block else np.minimum(total + counts, 2)
                block = at
        if block is not None:
            yield _batch([(block, np.packbits(total > 1).tobytes())], *types)

    parts = rows.select("prefix").mapInArrow(count, schema)
    added = parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, schema)
    bits = np.zeros((blocks, SKETCH_ROWS * columns // blocks // 8), dtype=np.uint8)
    for block, data in added.collect():
        bits[block] = np.frombuffer(data, dtype=np.uint8)
    return bits.reshape(-1)


def screened(rows: DataFrame, columns: int | None = None) -> DataFrame:
    """``rows`` of prefixes with ``alone``: the estimate of this prefix, or of the one above
    it, is one; and ``parent_alone`` for the latter alone."""
    if columns is None:
        wanted = 4 * max(1, rows.count())
        columns = min(max(1 << wanted.bit_length(), LEAST_COLUMNS), MOST_COLUMNS)
    spark = rows.sparkSession
    bits = spark.sparkContext.broadcast(sketch(rows, columns))

    def may_share(digests: pa.Array) -> np.ndarray:
        cells = _cells(digests, columns) + (np.arange(SKETCH_ROWS, dtype=np.uint64) * np.uint64(columns))[:, None]
        set_ = bits.value[cells >> np.uint64(3)] >> (np.uint64(7) - (cells & np.uint64(7))).astype(np.uint8) & 1
        return set_.all(axis=0)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parents = batch.column(batch.schema.get_field_index("parent"))
                above = ~may_share(parents.fill_null(ROOT)) & np.asarray(parents.is_valid())
                own = ~may_share(batch.column(batch.schema.get_field_index("prefix"))) | above
                for name, values in (("alone", own), ("parent_alone", above)):
                    batch = batch.append_column(name, pa.array(values))
                yield batch

    return rows.mapInArrow(mark, _PREFIX + ", alone boolean, parent_alone boolean")


def _looked_up(rows: DataFrame, nodes: DataFrame, on: str, names: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with columns of the node that ``on`` names. Nodes with many members are few,
    and looked up without moving the rows; rows of the others are in groups of bounded size."""
    hot = stored(nodes.filter(F.col("n_convs") > HOT_MEMBERS), "hot-nodes")
    found = nodes.select(F.col("prefix").alias(on), *names)
    if hot.isEmpty():
        return rows.join(found, on, how)
    keys = hot.select(F.col("prefix").alias(on), *names)
    warm = rows.join(keys, on)
    cold = rows.join(keys.select(on), on, "left_anti").join(found, on, how)
    return warm.unionByName(cold)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by prefix and number to the SHA-256 of their list, one id at a time."""
    types = ["prefix", "ends_sha256"], [pa.binary(), pa.string()]
    current, digest, done = None, None, []
    for batch in batches:
        for prefix, key in zip(*(batch.column(c).to_pylist() for c in ("prefix", "conversation"))):
            if prefix != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = prefix, hashlib.sha256(str(key).encode())
            else:
                digest.update(f",{key}".encode())
        yield _batch(done, *types)
        done = []
    if current is not None:
        yield _batch([(current, digest.hexdigest())], *types)


def trie(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    columns: int | None = None,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, all numbers long. ``columns`` sets the sketch."""
    rows = stored(prefixes(rebuilt(df, conversation, turn, role, text)), "prefixes")
    rows = stored(screened(rows, columns), "screened-prefixes")
    of_none = F.sha2(F.lit(""), 256)

    shared = rows.filter("NOT alone")
    nodes = stored(
        shared.groupBy("prefix").agg(
            F.min("conversation").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.min("words").alias("words"), F.count(F.lit(1)).alias("n_convs"), F.count_if("is_last").alias("n_ends"),
        ),
        "shared-nodes",
    )

    # What each conversation owns from each depth on. Its last row here is its end, or a tail
    # follows that nobody shares: one leaf of its own either way, unless others go on from it.
    placed = _looked_up(
        shared.select("conversation", "depth", "prefix", "is_last"), nodes, "prefix", ["conv_id", "words", "n_convs", "n_ends"]
    )
    owned = F.col("conversation") == F.col("conv_id")
    onward = Window.partitionBy("conversation").orderBy(F.desc("depth"))
    ends_here = F.when(F.col("is_last"), owned & (F.col("n_convs") == F.col("n_ends"))).otherwise(True)
    saved = F.when(owned, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    sums = (
        placed.withColumn("leaf", F.first(ends_here.cast("int")).over(onward))
        .withColumn("saved", F.sum(saved).over(onward))
        .groupBy("prefix")
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )

    # Children: shared nodes, and the first nodes of tails.
    tails = rows.filter("alone AND NOT parent_alone AND parent IS NOT NULL")
    children = (
        nodes.filter("parent IS NOT NULL").select("parent")
        .unionByName(tails.select("parent"))
        .groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
        .withColumnRenamed("parent", "prefix")
    )
    last = shared.filter("is_last").select("prefix", "conversation")
    ends = last.repartition("prefix").sortWithinPartitions("prefix", "conversation").mapInArrow(
        _hash_ids, "prefix binary, ends_sha256 string"
    )
    parents = nodes.select("prefix", F.col("conv_id").alias("parent_conv_id"), "n_convs")
    known = nodes.join(sums, "prefix").join(children, "prefix", "left").join(ends, "prefix", "left")
    below = _looked_up(known.filter("parent IS NOT NULL"), parents, "parent", ["parent_conv_id"], "left")
    top = known.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint"))

    def number(column: Column, name: str) -> Column:
        return F.coalesce(column, F.lit(0)).cast("bigint").alias(name)

    # A node that a wrong estimate sent here from inside a tail has the tail's only member.
    parent = F.when(F.col("parent").isNotNull(), F.coalesce("parent_conv_id", "conv_id"))
    grouped = below.unionByName(top, allowMissingColumns=True).select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), parent.alias("parent_conv_id"),
        "n_convs", number(F.col("n_children"), "n_children"), number(F.col("n_leaves"), "n_leaves"),
        number(F.col("saved_tokens"), "saved_tokens"), F.coalesce("ends_sha256", of_none).alias("ends_sha256"),
    )

    def alone(found: DataFrame, parent_id: Column) -> DataFrame:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return found.select(
            F.col("conversation").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"),
            parent_id.alias("parent_conv_id"), one.alias("n_convs"),
            F.when(F.col("is_last"), none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
            none.alias("saved_tokens"),
            F.when(F.col("is_last"), F.sha2(F.col("conversation").cast("string"), 256)).otherwise(of_none).alias("ends_sha256"),
        )

    inner = alone(rows.filter("parent_alone"), F.col("conversation"))
    first = _looked_up(
        tails.select("conversation", "depth", "parent", "is_last"), parents, "parent", ["parent_conv_id"], "left"
    )
    only = rows.filter("alone AND parent IS NULL")  # the root of a single conversation
    return (
        grouped.unionByName(inner)
        .unionByName(alone(first, F.coalesce("parent_conv_id", "conversation")))
        .unionByName(alone(only, F.lit(None).cast("bigint")))
    )
