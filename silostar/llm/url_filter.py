"""Allow and block lists for addresses: a broadcast trie, longest match first.

The trie goes down the reversed labels of the host and then the segments of the path. Each
address walks it once, so the cost does not depend on the number of rules.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm.common import key_text, typed

# A list whose trie is larger than this is refused before it is broadcast.
MAX_TRIE_BYTES = 256 << 20
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_PARTS = re.compile(r"([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty without a ``://``."""
    if url is None or "://" not in url:
        return "", ""
    host, path = _PARTS.match(url.partition("://")[2]).groups()
    return host.translate(_LOWER), path


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nodes are dicts. ``below`` holds the next host labels, ``path`` the first path node;
    path nodes hold the next whole segments, and in ``ends`` the rules that stop there: by
    the start of the next segment, empty if the rule's path ends in a slash.

    Of two equal rules the blocking one stays.
    """
    root: dict = {"below": {}}
    for verdict, host, path in sorted(rules):  # allow before block
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node["below"].setdefault(label, {"below": {}})
        node = node.setdefault("path", {"below": {}, "ends": {}})
        *segments, rest = path.split("/")
        for segment in segments:
            node = node["below"].setdefault(segment, {"below": {}, "ends": {}})
        node["ends"][rest] = (f"{host}{path}", verdict)
    return root


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits, by characters; of equally long ones that with the longer
    host."""
    best, node, segments = None, trie, path.split("/")
    for label in reversed(host.split(".")):
        node = node["below"].get(label)
        if node is None:
            break
        at = node.get("path")
        for segment in segments if at else ():
            for rest, found in at["ends"].items():
                if segment.startswith(rest) and (best is None or len(found[0]) >= len(best[0])):
                    best = found
            at = at["below"].get(segment)
            if at is None:
                break
    return best


def judge_urls(
    df: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of ``df``: key, host, path, rule, verdict. No shuffle.

    Without a fitting rule the verdict is ``default``, and ``block`` where there is no host
    (null, empty or malformed address): it cannot be attributed. Null keys and repeated rows
    pass through; other columns of ``df`` are not read.
    """
    trie = build_trie(rules)
    if len(pickle.dumps(trie)) > MAX_TRIE_BYTES:
        raise ValueError("the list is too large to broadcast; split it by host and union")
    shared = df.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for batch in batches:
            rows = []
            for address in batch["url"]:
                host, path = split_url(address)
                found = match(tree, host, path) if host else None
                rule, verdict = found or (None, default if host else "block")
                rows.append((host, path, rule, verdict))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)
            out.insert(0, "key", batch["key"].array)
            yield out

    rows = df.select(key_text(key), F.col(url).alias("url"))
    judged = rows.mapInPandas(run, "key string, host string, path string, rule string, verdict string")
    return typed(judged, df, key).withColumnRenamed("key", key)
