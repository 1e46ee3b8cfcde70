"""Hierarchical packing: tiers of context sizes, gaps of long windows filled from short tiers.

Documents become token ids with an end id. Whole windows of the longest size are cut off; the
rest is routed to the smallest tier that holds it. From the longest tier down, every piece
opens a window of its tier, the window is filled with the longest shorter pieces that fit, and
the last gap takes the head of one more piece. Windows are thus exactly full. What a task has
left at its end is dealt into windows of smaller powers of two, which need no padding either.
Windows are then dealt to step groups of about the same number of tokens.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silostar.llm import tokens
from silostar.llm.common import key_text, typed

TIERS = (256, 512, 1024, 2048)
END_ID = 1
# Tokens of one step group.
STEP_TOKENS = 1 << 17
# Rests of documents that a task holds before it packs them, and their tokens at most.
HELD_PIECES = 4096
HELD_TOKENS = 4 << 20


class Packer:
    """Packs pieces ``(length, order, document, start)``; yields groups of windows, a window
    being a list of ``(document, start, length)``."""

    def __init__(self, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        if any(t & (t - 1) for t in tiers):
            raise ValueError("context sizes must be powers of two")
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.pool: list[tuple] = []  # rests, by length
        self.full: list[list[tuple]] = []  # finished windows
        self.held = self.order = 0

    def add(self, document, length: int) -> None:
        window, start = self.tiers[-1], 0
        while length - start >= window:
            self.full.append([(document, start, window)])
            start += window
        self.held += length
        self._put(document, start, length - start)

    def _put(self, document, start: int, length: int) -> None:
        if length:
            self.order += 1
            insort(self.pool, (length, self.order, document, start))

    def _window(self, size: int) -> list[tuple] | None:
        """A full window that starts with the longest piece, or none if too little is left."""
        length, _, document, start = self.pool.pop()
        window, gap = [(document, start, length)], size - length
        while gap and self.pool:
            k = bisect_right(self.pool, (gap, float("inf")))
            if k:
                taken, _, document, start = self.pool.pop(k - 1)
            else:  # all are longer: the head of the shortest
                rest, _, document, start = self.pool.pop(0)
                taken = gap
                self._put(document, start + taken, rest - taken)
            window.append((document, start, taken))
            gap -= taken
        if gap:
            for document, start, taken in window:
                self._put(document, start, taken)
            return None
        return window

    def ready(self) -> bool:
        return len(self.pool) >= HELD_PIECES or self.held >= HELD_TOKENS

    def flush(self, final: bool) -> list[list[list[tuple]]]:
        """The windows packed so far, in groups. The last call leaves nothing."""
        while self.pool:
            size = self.tiers[bisect_left(self.tiers, self.pool[-1][0])]
            window = self._window(size)
            if window is None:
                break
            self.full.append(window)
        if final:
            self._deal_rest()
        windows, self.full, self.held = self.full, [], 0
        return self._groups(windows)

    def _deal_rest(self) -> None:
        left = sum(piece[0] for piece in self.pool)
        while left:  # the largest power of two that can be filled; ends with one token
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            window = []
            while size:
                length, _, document, start = self.pool.pop()
                taken = min(size, length)
                self._put(document, start + taken, length - taken)
                window.append((document, start, taken))
                size -= taken
                left -= taken
            self.full.append(window)

    def _groups(self, windows: list[list[tuple]]) -> list[list[list[tuple]]]:
        """Longest first, each to the group with the fewest tokens."""
        sized = sorted(((sum(p[2] for p in w), -k, w) for k, w in enumerate(windows)), reverse=True)
        count = max(1, round(sum(s for s, _, _ in sized) / self.step_tokens))
        groups: list[list] = [[] for _ in range(min(count, len(windows)))]
        load = [(0, g) for g in range(len(groups))]
        for size, _, window in sized:
            tokens_, g = heapq.heappop(load)
            groups[g].append(window)
            heapq.heappush(load, (tokens_ + size, g))
        return groups


def pack(
    df: DataFrame, tokenizer: str, tiers=TIERS, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, sequence_length, step_group. No shuffle: a task packs what it reads.

    A sequence holds at most the longest tier, and its length is a power of two. Null and
    empty texts are the end id alone. Rows are packed one by one, so that null and repeated
    keys are separate documents. Very long texts are cut at whole windows as they are met.
    Numbers of sequences and groups carry the task's number, which follows from the input's
    files, so that a task that runs again gives the same rows.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = tokens.WordLevelIds(tokenizer), Packer(tiers)
        base = TaskContext.get().partitionId() << 36
        held: dict[int, tuple] = {}
        number = sequences = groups = 0
        columns = ("key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                   "sequence_length", "step_group")

        def rows(final: bool) -> pd.DataFrame:
            nonlocal sequences, groups
            out = []
            for group in packer.flush(final):
                for window in group:
                    size, offset = sum(p[2] for p in window), 0
                    for document, start, length in window:
                        name, ids = held[document]
                        out.append((name, start, length, ids[4 * start : 4 * (start + length)],
                                    len(ids) // 4, base + sequences, offset, size, base + groups))
                        offset += length
                    sequences += 1
                groups += 1
            left = {piece[2] for piece in packer.pool}
            for document in [d for d in held if d not in left]:
                del held[document]
            frame = pd.DataFrame(out, columns=columns)
            frame["key"] = pd.Series([r[0] for r in out], dtype=object)
            return frame

        for batch in batches:
            ids = encode([x or "" for x in batch["text"]])
            for name, found in zip(batch["key"], ids):
                found += end
                held[number] = (name, found)
                packer.add(number, len(found) // 4)
                number += 1
                if packer.ready():
                    yield rows(False)
        yield rows(True)

    pieces = df.select(key_text(key), F.col(text).alias("text")).mapInPandas(
        run, "key string, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, sequence_length long, step_group long"
    )
    return typed(pieces, df, key).withColumnRenamed("key", key)
