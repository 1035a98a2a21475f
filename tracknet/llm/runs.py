"""Periodic runs of words, by Kruskal's rounds over descending LCP.

A run is a stretch of words in which words ``period`` apart are identical, of
at least ``POWER`` periods and ``LEAST`` words, that cannot be extended to
either side. Suffixes of a text are sorted by prefix doubling. The longest
common prefixes (LCP) of neighbours in that order are the edges of a tree:
taken from the longest down, they unite suffix classes with union-find, and
each class keeps its positions in order. When two classes unite at LCP L, all
pairs across them have exactly L words in common. Positions i < j that become
neighbours in the united class at a distance within L seed a run: the words
from i on repeat with period j - i for L + j - i words. A smaller period of
that stretch would have put a position between them before, so the period is
the smallest; and if the words before i and j differ, i is the run's start, so
each run is found once, at its start, and is maximal.

Runs that are long enough have LCP of at least ``LEAST * (POWER - 1) / POWER``
at their start, so the rounds end there, and a text none of whose windows of so
many words repeats has no runs. This test compares hashes (equal windows have
equal ones); everything after it compares words. Smaller classes go into larger
ones: n log n steps. Texts are taken one by one; memory follows the longest.

Defined results: a null, empty or short text has no runs. Repeated rows are
worked out each. Null ids are kept, extra columns are not read, an empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.llm import words as W

LEAST = 24
POWER = 3
#: Positions in a block of an ordered set.
BLOCK = 2048

Run = tuple[int, int, int]     # start, length, period


class Positions:
    """Positions in order, in blocks, so that an insertion moves few of them."""

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.firsts = [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, x: int) -> int:
        return max(0, bisect_left(self.firsts, x + 1) - 1)

    def add(self, x: int) -> None:
        k = self._block(x)
        block = self.blocks[k]
        insort(block, x)
        self.firsts[k] = block[0]
        self.size += 1
        if len(block) > BLOCK:
            self.blocks[k:k + 1] = [block[:BLOCK // 2], block[BLOCK // 2:]]
            self.firsts[k:k + 1] = [block[0], block[BLOCK // 2]]

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The neighbours of a position of the set."""
        k = self._block(x)
        block = self.blocks[k]
        i = bisect_left(block, x)
        before = block[i - 1] if i else (self.blocks[k - 1][-1] if k else None)
        after = block[i + 1] if i + 1 < len(block) else (self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None)
        return before, after


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words, equal numbers."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def sorted_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order and the words that each shares with the next."""
    n = len(ids)
    levels, step = [np.unique(ids, return_inverse=True)[1]], 1
    while step < n and int(levels[-1].max()) < n - 1:
        rank = levels[-1]
        beyond = np.zeros(n, np.int64)
        beyond[:n - step] = rank[step:] + 1
        levels.append(np.unique(rank * (n + 1) + beyond, return_inverse=True)[1])
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    i, j, same = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # a place that has reached the end of the text has no words left
        inside = np.flatnonzero(np.maximum(i, j) < n)
        equal = inside[levels[k][i[inside]] == levels[k][j[inside]]]
        for x in (same, i, j):
            x[equal] += 1 << k
    return order, same


def find_runs(ids: np.ndarray, least: int = LEAST, power: int = POWER) -> list[Run]:
    """All runs of a word sequence by start, then period."""
    n = len(ids)
    floor = max(1, -(-least * (power - 1) // power))
    if n < least:
        return []
    with np.errstate(over="ignore"):
        seen = np.sort(W.windows(W.mix(ids.astype(np.uint64) + np.uint64(1)), floor))
    if not (seen[1:] == seen[:-1]).any():
        return []
    order, same = sorted_suffixes(ids)
    edges = np.flatnonzero(same >= floor)
    edges = edges[np.argsort(-same[edges], kind="stable")]
    words = ids.tolist()
    up: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def top(x: int) -> int:
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while up.get(x, root) != root:
            up[x], x = root, up[x]
        return root

    found = []

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if d * (power - 1) <= common and common + d >= least and (i == 0 or words[i - 1] != words[j - 1]):
            found.append((i, common + d, d))

    for a, b, common in zip(order[edges].tolist(), order[edges + 1].tolist(), same[edges].tolist(), strict=True):
        ra, rb = top(a), top(b)
        big, small = sets.pop(ra, None) or Positions(a), sets.pop(rb, None) or Positions(b)
        if big.size < small.size:
            big, small, ra, rb = small, big, rb, ra
        new = list(small)
        for x in new:
            big.add(x)
        fresh = set(new)
        for x in new:
            before, after = big.around(x)
            if before is not None and before not in fresh:
                seed(before, x, common)
            if after is not None and after not in fresh:
                seed(x, after, common)
        up[rb] = ra
        sets[ra] = big
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length over period; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those after the first period of a run, one space between."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()
    return b" ".join([words[k] for k in kept])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _shown(run: Run) -> dict[str, int]:
    return dict(zip(("start", "length", "period"), run, strict=True))


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """``(id, n_words, runs, strongest, collapsed)`` per row: the runs as
    ``(start, length, period)`` in words, the strongest (or null), and the text
    with each run cut down to its first period."""
    if least < 2 or power < 2:
        raise ValueError("a run has at least 2 words and 2 periods")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                n, runs, most, left = [], [], [], []
                for raw in W.text_bytes(part.column(1)):
                    words = raw.tobytes().split()
                    got = find_runs(word_numbers(words), least, power) if len(words) >= least else []
                    n.append(len(words))
                    runs.append([_shown(r) for r in got])
                    most.append(_shown(s) if (s := strongest(got)) else None)
                    left.append(collapse(words, got))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(most, _RUN),
                                                  pa.array(left, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "strongest", "collapsed"])

    shape = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, runs array<{shape}>, strongest {shape}, collapsed string")
