"""Repair of conversations and the trie of their beginnings, against plain versions."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silostar.llm import conversation_repair as repair
from silostar.llm import prefix_trie as trie
from silostar.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
BIG = 2**53 + 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[3])))


# Repair ---------------------------------------------------------------------
def cheapest(rows):
    """All lists of edits of (role, text, fault), by plain recursion over a few rows."""
    best = None

    def go(i, roles, cost, audit, lines, inserts):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        if not "s?(ua)+".startswith(roles) and not re.match("s?(ua)*u?$", roles):
            return
        if inserts < 2:
            for role in ("user", "assistant"):
                go(i, roles + role[0], cost + 5, audit + "I", [*lines, f"{role}:"], inserts + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, roles, cost + 2, audit + "D", lines, 0)
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                go(i + 1, roles + (role[:1] or "?"), cost + more, audit + "K", [*lines, f"{role}:{text}"], 0)
                for other in ("user", "assistant"):
                    go(i + 1, roles + other[0], cost + 1 + more, audit + "R", [*lines, f"{other}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    return best


def repaired(rows):
    """conv_id -> result, from rows of (conv_id, turn, role, text)."""
    groups = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        groups[conv] += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, found in groups.items():
        found, seen, judged = order(found), set(), []
        for _, _, role, text in found:
            shown = text.rstrip(SPACES)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else None
            fault = fault or (None if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {r[1] for r in found} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = [f for _, _, f in judged]
        initials = [r[:1] for r, _, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(judged)
        out[conv] = (gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(seed, ids, turns):
    pick = random.Random(seed)
    texts = ["Yes.", "Yes.", "No!", "cut off", " \t", "", None, "a. b? \n", "Zürich.", "end. ", "x" * 50 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    return [
        (conv, pick.choice([None, 0, 1, 2, 3, 7]) if k else 0, pick.choice(roles), pick.choice(texts))
        for conv in ids for k in range(pick.randrange(1, turns))
    ]


def test_repair_against_all_lists_of_edits(frame):
    rows = random_rows(1, [*range(60), None, -5, BIG], 6)
    df = frame(SCHEMA + ", audit string, cost long, digest string", *((*r, "x", 1, "y") for r in rows))
    assert result(repair.repair(df)) == repaired(rows)


def test_repair_over_many_partitions(spark, frame):
    rows = random_rows(2, range(40), 5)
    assert result(repair.repair(frame(SCHEMA, *rows).repartition(7))) == repaired(rows)


def test_repair_of_no_rows_and_of_rows_that_all_go(frame):
    assert result(repair.repair(frame(SCHEMA))) == {}
    lost = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    none = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert result(repair.repair(frame(SCHEMA, (lost, 0, "user", "Hello.")))) == {lost: none}


CODES = "-suaxSUAX"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=CODES, max_size=5))
def test_search_finds_the_least_cost_and_audit(codes):
    rows = [("blank", "", "blank") if c == "-" else (c.lower(), "t", "truncated" if c.isupper() else None) for c in codes]
    cost, audit, _ = cheapest(rows)
    assert repair.search(codes.encode()) == (cost, audit)


def test_a_long_conversation_is_searched_in_time_that_follows_its_length():
    pick = random.Random(3)
    codes = "".join(pick.choices(CODES, k=30_000)).encode()
    cost, audit = repair.search(codes)
    assert sum(e != repair.INSERT for e in audit) == len(codes)
    assert cost <= 2 * len(codes)
    over, step, total = repair.suffix_bounds(codes)
    assert cost == total + over[repair.NONE]


def test_a_conversation_with_a_third_of_all_rows(frame):
    rows = [(1, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(3000)]
    rows += [(k, 0, "user", "Hi.") for k in range(10, 1000)]
    found = result(repair.repair(frame(SCHEMA, *rows).repartition(5)))
    assert len(found) == 991
    assert len([e for e in found[1][6] if e != "I"]) == 3000 - sum(
        zlib.crc32(f"1:{t}".encode()) % 20 == 0 for t in range(3000)
    ) + sum(zlib.crc32(f"1:{t}".encode()) % 20 == 3 for t in range(3000))
    assert found[1][2] == sum(zlib.crc32(f"1:{t}".encode()) % 20 == 3 for t in range(3000))


# Trie -----------------------------------------------------------------------
def nodes(rows):
    """All nodes, from rows of (conv_id, turn, role, text), by walking over all prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((conv, turn, role or "", text or ""))
    own = {c: [(r[2], r[3]) for r in order(found)] for c, found in own.items()}
    paths = {}
    for conv in own:
        rest = abs(conv) % 20 * (1 if conv >= 0 else -1)
        h = zlib.crc32(str(conv).encode()) % 4
        paths[conv] = tuple(own.get(conv - rest, [])[:h] + own[conv][h:])
    members, children = {}, {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
    out = []
    for top, held in members.items():
        below = [n for n in members if n[: len(top)] == top]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(held) if paths[c] == top)
        parent = min(members[top[:-1]]) if top else None
        leaves = sum(n not in children for n in below)
        out.append((min(held), len(top), parent, len(held), len(children.get(top, ())), leaves, saved, sha(ends)))
    return sorted(out, key=repr)


def shared_rows(seed, ids):
    pick = random.Random(seed)
    turns = [("user", "Hello there."), ("user", "Hello  there."), ("assistant", "a b c"), (None, None), ("", ""), ("system", "x\ny")]
    return [
        (conv, pick.choice([None, 0, 1, 2]) if pick.random() < 0.2 else k, *pick.choice(turns))
        for conv in ids for k in range(pick.randrange(1, 7))
    ]


def found(df, **options):
    return sorted((tuple(r) for r in trie.trie(df, **options).collect()), key=repr)


@pytest.mark.parametrize("columns", [None, 2, 64])
def test_trie_against_all_prefixes(frame, columns):
    """With two columns nearly every estimate is wrong: all nodes are grouped exactly."""
    rows = shared_rows(4, [*range(70), -3, -45, BIG, BIG + 2, None])
    df = frame(SCHEMA + ", depth long, prefix string", *((*r, 9, "x") for r in rows)).repartition(5)
    assert found(df, columns=columns) == nodes(rows)


def test_trie_of_unlike_conversations_and_of_one(frame):
    rows = [(k, t, "user", f"{k} {t}") for k in range(0, 200, 20) for t in range(4)]
    assert found(frame(SCHEMA, *rows)) == nodes(rows)
    assert found(frame(SCHEMA, *rows[:3])) == nodes(rows[:3])
    assert found(frame(SCHEMA)) == [] and found(frame(SCHEMA, (None, 0, "user", "x"))) == []


def test_trie_with_a_hot_beginning_and_a_hot_conversation(frame, monkeypatch):
    monkeypatch.setattr(trie, "HOT_MEMBERS", 5)
    rows = [(k, t, "user", "same" if t < 2 or k % 3 else f"own {k}") for k in range(60) for t in range(3)]
    rows += [(7, t, "assistant", f"turn {t}") for t in range(3, 120)]
    assert found(frame(SCHEMA, *rows).repartition(6)) == nodes(rows)


def test_tails_are_not_shuffled(frame):
    rows = [(k, t, "user", "hello" if t == 0 else f"{k} {t}") for k in range(0, 400, 20) for t in range(10)]
    prefixes = stored(trie.prefixes(trie.rebuilt(frame(SCHEMA, *rows), "conv_id", "turn", "role", "text")), "test")
    assert trie.screened(prefixes).filter("NOT alone").count() == 40  # the root and the shared turn


def test_prefixes_of_parts_that_are_already_placed_by_conversation(frame, spark):
    """Small partitions of each part are merged on their own: the prefixes need their own exchange."""
    schema = "conversation long, depth int, digest binary, words int"
    turns = frame(schema, *((k, d, b"%d %d" % (k, d), 1) for k in range(40) for d in range(1, 30)))
    tops = frame(schema, *((k, 0, None, 0) for k in range(40)))
    placed = turns.repartition("conversation").unionByName(tops.repartition("conversation"))
    settings_ = {"advisoryPartitionSizeInBytes": "2k", "coalescePartitions.minPartitionSize": "1k", "coalescePartitions.parallelismFirst": "false"}
    for name, value in settings_.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        rows = trie.prefixes(placed).collect()
    finally:
        for name in settings_:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    by_place = {(r.conversation, r.depth): r for r in rows}
    assert len(rows) == len(by_place) == 40 * 30
    assert all(r.parent == by_place[r.conversation, r.depth - 1].prefix for r in rows if r.depth)
    assert {(r.conversation, r.depth) for r in rows if r.is_last} == {(k, 29) for k in range(40)}
