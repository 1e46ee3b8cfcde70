"""Repair of the structure of conversations at the least cost of edits.

A repaired conversation is empty, or an optional system turn and then pairs of user and
assistant turns. Each row may be kept, given another role, or deleted, and empty turns may be
inserted. The cheapest list of edits of a conversation is found by depth-first branch and
bound with an explicit stack:

* a node is a row and the role before it; a branch is an edit. Branches are tried by their
  bound, those of one bound in ASCII order;
* a lower bound of what the rest of the conversation costs from each node is worked out from
  the end of the conversation. It is tight, so the first dive ends at the least cost, and
  prefixes that can still cost as little come up in ASCII order;
* the incumbent is the best (cost, audit) so far; a branch whose bound does not beat it is cut;
* a dominance table per node cuts a prefix that reaches a node at no less cost than an
  earlier one, whose audit is smaller.

The search sees a byte per turn. Texts never meet in it: small records are grouped and sorted
by conversation, searched, and the edits are then sorted in front of the texts, which are
hashed as they stream by. Both passes hold a few bytes per turn of one conversation (as many
letters as its audit has), and no text but the one at hand, so a conversation with a third of
all rows needs sorted spills, not memory. A SHA-256 is sequential, so its texts do pass one task.

Rows: turns are ordered by number, nulls first, then by role and by the SHA-256 of the text;
repeated rows stay and count as duplicates. Null ids are one conversation of their own. A null
role or text is one space, which is no role and a blank text; an empty role has no initial, and
such a row cannot be kept as it is. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import stored

# The edits by their initials, what they cost, and the roles.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
ROLES = {"u": "user", "a": "assistant"}
FIRST_PAIRS = ("su", "ua", "au")
SPACE = r"[\x20\x09-\x0D]"

# Role before a row: none, system, user, assistant; where a role leads from there.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_WANTED = "uuau"  # the role that an inserted or changed row takes
_ENDS = (NONE, ASSISTANT)
_FAR = 200  # more than any two nodes of a row differ in what is left
# A row in a byte: role initial (lower case if whole, upper case if truncated), or deleted.
GONE = "-"
_CACHED_TURNS = 64


# Damage, in DataFrame functions ----------------------------------------------
def damaged(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """conversation, turn, role, text, copy: the rows after the fixed faults, nulls as a space.
    The fault of a row is chosen by the CRC-32 of its conversation and turn."""
    space = F.lit(" ")
    named = F.concat_ws(
        ":", F.coalesce(F.col(conversation).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space)
    )
    rows = df.select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
        (F.crc32(named) % 20).alias("fault"),
    ).filter("fault <> 0")
    fault = F.col("fault")
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conversation", "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit(""))
        .when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _records(rows: DataFrame) -> DataFrame:
    """conversation, turn, role, digest, code, initial, first_turn: what the search needs of
    each row. ``first_turn`` is the earliest turn with this role and text, where there are
    several turns with it (a null turn is the lowest number)."""
    trimmed = F.regexp_replace("text", f"{SPACE}+$", "")
    blank = trimmed == ""
    whole = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    code = F.when(blank, F.lit(GONE)).when(whole, known).otherwise(F.upper(known))
    records = rows.select(
        "conversation", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        code.alias("code"), initial.alias("initial"),
    )
    low = F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 63)))
    again = (
        records.filter(F.col("code") != GONE)
        .groupBy("conversation", "role", "digest")
        .agg(F.min(low).alias("first_turn"), F.max(low).alias("last_turn"))
        .filter("first_turn < last_turn")
        .drop("last_turn")
    )
    a, b = records.alias("a"), again.alias("b")
    on = F.col("a.conversation").eqNullSafe(F.col("b.conversation"))
    on = on & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    return a.join(b, on, "left").select("a.*", (low > F.col("b.first_turn")).alias("seen"))


# Search ----------------------------------------------------------------------
def _row_edits(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up a row, in ASCII order."""
    yield DELETE, COST[DELETE], state
    if code == GONE:
        return
    own, more = code.lower(), TRUNCATED_COST if code.isupper() else 0
    if own in _NEXT[state]:
        yield KEEP, COST[KEEP] + more, _NEXT[state][own]
    wanted = _WANTED[state]
    if own != wanted:
        yield REROLE, COST[REROLE] + more, _NEXT[state][wanted]


# All codes and states: a small table instead of work per row.
_EDITS = {
    ord(code): [list(_row_edits(code, state)) for state in range(4)]
    for code in (GONE, *"suaxSUAX")
}
_INSERTED = [_NEXT[state][_WANTED[state]] for state in range(4)]


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs by state, where a state may also take inserted rows (two at most help)."""
    for _ in range(2):
        costs = [min(c, COST[INSERT] + costs[_INSERTED[q]]) for q, c in enumerate(costs)]
    return costs


def suffix_bounds(codes: bytes) -> tuple[bytearray, bytearray, int]:
    """What the rows from each one on cost at least, by state: four bytes a row above the
    least of the four, the steps of that least from row to row, and its value at the start."""
    n = len(codes)
    over, step = bytearray(4 * (n + 1)), bytearray(n + 1)
    costs = _with_inserts([0 if q in _ENDS else _FAR for q in range(4)])
    total = 0
    for i in range(n, -1, -1):
        if i < n:
            edits = _EDITS[codes[i]]
            costs = _with_inserts([min(c + costs[q] for _, c, q in edits[state]) for state in range(4)])
        least = min(costs)
        costs = [c - least for c in costs]
        over[4 * i : 4 * i + 4] = bytes(costs)
        step[i] = least
        total += least
    return over, step, total


def search(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, ASCII-least among these, proved by branch and bound.

    Costs are counted above the bound at the start: the excess of a node is what its prefix
    and the bound of its rest together cost more than that. As the bound is tight, the
    incumbent to beat is set just above it.
    """
    n = len(codes)
    over, step, total = suffix_bounds(codes)
    best, audit = 1, None
    reached = bytearray(b"\xff") * (4 * (n + 1))  # dominance: the least excess per node
    path = bytearray()
    # The stack in two arrays: node, excess and edit in one number, and the edits before it.
    stack, depths = array("Q", [NONE << 16]), array("Q", [0])
    while stack:
        entry, depth = stack.pop(), depths.pop()
        node, excess, edit = entry >> 16, entry >> 8 & 0xFF, entry & 0xFF
        if excess >= reached[node] or excess >= best:
            continue  # another audit came here, or to the end, as cheaply and is smaller
        reached[node] = excess
        del path[depth:]
        if edit:
            path.append(edit)
        i, state = node >> 2, node & 3
        if i == n and state in _ENDS:
            best, audit = excess, bytes(path)
            continue
        depth, bound = len(path), excess - over[node]
        to = 4 * i + _INSERTED[state]
        branches = [(bound + COST[INSERT] + over[to], ord(INSERT), to)]
        if i < n:
            for initial, cost, q in _EDITS[codes[i]][state]:
                to = 4 * i + 4 + q
                branches.append((bound + cost + over[to] - step[i], ord(initial), to))
        for more, initial, to in sorted(branches, reverse=True):  # the last one goes first
            if more < best:
                stack.append(to << 16 | more << 8 | initial)
                depths.append(depth)
    return total + over[NONE], audit.decode()


_search_short = lru_cache(50_000)(search)


def repair_codes(codes: bytes) -> tuple[int, str]:
    """As ``search``; the results of short conversations are kept."""
    return _search_short(codes) if len(codes) <= _CACHED_TURNS else search(codes)


# Passes over sorted rows ------------------------------------------------------
_FOUND = (
    "conversation bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string"
)


def _search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by conversation, turn, role and digest to a result per conversation."""
    names = [f.split()[0] for f in _FOUND.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()]
    done: list[tuple] = []
    current, started = None, False
    codes, tally, before, turns = bytearray(), {}, None, [None, None, 0]

    def close():
        cost, audit = repair_codes(bytes(codes))
        low, high, distinct = turns
        gaps = high - low + 1 - distinct if distinct else 0
        counts = [tally.get(k, 0) for k in ("blank", "duplicate", "truncated", "illegal")]
        done.append((current, gaps, *counts, cost, audit))

    def flush():
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)] if done else [pa.array([], t) for t in types]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for key, turn, role, digest, code, initial, seen in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or key != current:
                if started:
                    close()
                current, started = key, True
                codes, tally, before, turns = bytearray(), {}, None, [None, None, 0]
            if turn is not None and turn != turns[1]:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            same = before is not None and before[:3] == (turn, role, digest)
            if code == GONE:
                fault = "blank"
            elif seen or same:
                fault, code = "duplicate", GONE
            else:
                fault = "truncated" if code.isupper() else None
            if fault:
                tally[fault] = tally.get(fault, 0) + 1
            if before is not None and before[3] + initial not in FIRST_PAIRS:
                tally["illegal"] = tally.get("illegal", 0) + 1
            before = (turn, role, digest, initial)
            codes += code.encode()
        if len(done) >= 1000:
            yield flush()
    if started:
        close()
    yield flush()


def _hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted like the records, each conversation's audit in front, to the SHA-256 of
    each repaired conversation. Texts are hashed one by one."""
    done: list[tuple] = []
    current, started = None, False
    digest, audit, at, state, lines = hashlib.sha256(), "", 0, NONE, 0

    def line(role: str, text: str):
        nonlocal lines
        digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
        lines += 1

    def insert():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            line(ROLES[_WANTED[state]], "")
            state, at = _INSERTED[state], at + 1

    def close():
        insert()
        done.append((current, digest.hexdigest()))

    def flush():
        keys, hashes = zip(*done) if done else ((), ())
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(hashes, pa.string())], ["conversation", "repaired_sha256"]
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conversation", "role", "text", "audit")]
        for key, role, text, found in zip(*columns):
            if found is not None:  # the first row of a conversation
                if started:
                    close()
                current, started, audit = key, True, found
                digest, at, state, lines = hashlib.sha256(), 0, NONE, 0
                continue
            insert()
            edit, at = audit[at], at + 1
            if edit == DELETE:
                continue
            if edit == REROLE:
                role = ROLES[_WANTED[state]]
            state = _NEXT[state][role[0]]
            line(role, text)
        if len(done) >= 1000:
            yield flush()
    if started:
        close()
    yield flush()


def repair(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation id of ``df``, rows of which are first damaged: conversation,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = damaged(df, conversation, turn, role, text)
    order = ["conversation", F.col("turn").asc_nulls_first(), "role", "digest"]
    records = _records(rows).repartition("conversation").sortWithinPartitions(*order)
    found = stored(records.mapInArrow(_search_all, _FOUND), "repairs")

    front = found.select(
        "conversation", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), "audit",
    )
    texts = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(front)
    texts = texts.repartition("conversation").sortWithinPartitions(
        "conversation", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", F.sha2("text", 256)
    )
    hashed = texts.mapInArrow(_hash_all, "conversation bigint, repaired_sha256 string")

    every = df.select(F.col(conversation).cast("bigint").alias("conversation")).distinct().alias("a")
    b, c = found.alias("b"), hashed.alias("c")

    def same(x: str, y: str) -> Column:
        return F.col(x).eqNullSafe(F.col(y))

    names = [f.split()[0] for f in _FOUND.split(", ")][1:-1]
    return (
        every.join(b, same("a.conversation", "b.conversation"), "left")
        .join(c, same("a.conversation", "c.conversation"), "left")
        .select(
            F.col("a.conversation").alias(conversation),
            *[F.coalesce(f"b.{n}", F.lit(0).cast("bigint")).alias(n) for n in names],
            F.coalesce("b.audit", F.lit("")).alias("audit"),
            F.coalesce("c.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
