"""Periodic runs of words by a descending-LCP Kruskal over suffix classes.

A run is a longest stretch of consecutive words in which words q apart are identical, q being its smallest
period, with a length of at least 2 * q and of `min_length`. Suffixes that begin alike are vertices, neighbours in
the suffix order are edges weighted by the length of their longest common prefix (LCP). Edges are taken by
decreasing weight, as in Kruskal's algorithm; a union-find joins the classes, and each class keeps its positions
in order. Two positions i < j that become neighbours in a class at LCP l with j - i <= l repeat words from i on
with the period j - i up to j + l, and no shorter one: a position between them that begins alike for l words
would already lie between them. Conversely the first and the second period of every run become neighbours
at that run's own LCP. So the pairs that cannot be moved to the left are the runs, each found once.

Documents of a batch are sorted together by doubling prefixes; classes of one suffix are settled and leave, so
after two or three rounds only what really repeats is sorted on. Only LCPs that a run of `min_length` needs become edges.

Defined results
---------------
* Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and return. A null, empty or
  blank text has no words and no runs.
* `collapsed` holds the words outside every run, and of each run the first period, joined by one blank; a word
  that one run drops is dropped although another run keeps it.
* Rows are judged on their own: null and repeated ids, ties and repeated rows need no rule. Of the longest runs the
  one with the smallest start, then the smallest period is the first.
* Texts of any length are looked at whole. A worker needs about a hundred bytes per word of its block, plus
  four per word for each doubling of the longest passage that repeats inside one document.
* Empty tables give empty results. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
# Texts looked at together, in bytes: a longer text is a block of its own.
BLOCK_BYTES = 2 << 20


def suffix_order(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(positions in suffix order, ranks after 1, 2, 4, … words) of documents that lie side by side.

    `doc` and `end` give each position its document and that document's end. Equal ranks at level k mean that
    2**k words are equal, inside one document. The order of words is any fixed order.
    """
    n = len(words)
    order = np.argsort(doc * (int(words.max()) + 1) + words, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = (words[order[1:]] != words[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, step = [rank.astype(np.int32 if n < 2**31 else np.int64)], 1
    alone = fresh & np.concatenate([fresh[1:], [True]])
    slots = np.flatnonzero(~alone)
    while len(slots):
        at = order[slots]
        beyond = at + step
        second = np.where(beyond < end[at], rank[np.minimum(beyond, n - 1)], -1)
        first = rank[at]
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        order[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        heads = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        rank[at] = slots[heads]
        levels.append(rank.astype(levels[0].dtype))
        slots = slots[~(fresh & np.concatenate([fresh[1:], [True]]))]
        step *= 2
    return order, levels


def neighbours(order: np.ndarray, levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, LCP) of neighbours in the suffix order that share at least `least` words."""
    left, right = order[:-1], order[1:]
    known = min(least.bit_length() - 1, len(levels) - 1)
    kept = levels[known][left] == levels[known][right]
    left, right = left[kept], right[kept]
    lcp = np.zeros(len(left), np.int64)
    size = len(order)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.append(levels[k], -1)
        same = padded[np.minimum(left + lcp, size)] == padded[np.minimum(right + lcp, size)]
        # Only one of the two can stand at the end of the texts, so -1 never meets -1.
        lcp += same.astype(np.int64) << k
    enough = lcp >= least
    return left[enough], right[enough], lcp[enough]


class OrderedClasses:
    """Union-find whose classes know their positions in order.

    Positions are kept negated: a run grows its classes to the left, so they mostly grow at the end.
    """

    def __init__(self) -> None:
        self.of: dict[int, list[int]] = {}
        self.next: dict[int, int] = {}

    def unite(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Unite the classes of each pair; returns the (position, following position) that are new neighbours."""
        touched: list[int] = []
        for a, b in pairs:
            x, y = self.of.setdefault(a, [-a]), self.of.setdefault(b, [-b])
            if x is y:
                continue
            if len(x) < len(y):
                x, y = y, x
            if 8 * len(y) < len(x):
                for p in y:
                    insort(x, p)
            else:
                x += y
                x.sort()
            for p in y:
                self.of[-p] = x
            touched += y
        found = []
        for p in touched:
            line = self.of[-p]
            k = bisect_left(line, p)
            # Negated order: what follows a position stands before it.
            if k > 0:
                self._follow(-p, -line[k - 1], found)
            if k + 1 < len(line):
                self._follow(-line[k + 1], -p, found)
        return found

    def _follow(self, position: int, following: int, found: list[tuple[int, int]]) -> None:
        if self.next.get(position) != following:
            self.next[position] = following
            found.append((position, following))


def runs_of(words: np.ndarray, doc: np.ndarray, end: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, positions counted over all documents, in order."""
    if not len(words):
        return []
    # A run of period q has an LCP of length - q, at least max(min_length - q, q).
    order, levels = suffix_order(words, doc, end)
    left, right, lcp = neighbours(order, levels, max(1, -(-min_length // 2)))
    by = np.argsort(-lcp, kind="stable")
    edges = zip(lcp[by].tolist(), left[by].tolist(), right[by].tolist())
    classes, runs = OrderedClasses(), []
    for shared, group in groupby(edges, key=lambda e: e[0]):
        for i, j in classes.unite([(a, b) for _, a, b in group]):
            period = j - i
            if period <= shared and period + shared >= min_length:
                if i == 0 or doc[i - 1] != doc[i] or words[i - 1] != words[j - 1]:
                    runs.append((i, period + shared, period))
    runs.sort()
    return runs


def find_runs(texts: list[bytes], min_length: int = MIN_LENGTH) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Per text: its runs (start, length, period) by start and period, and the text without repetitions."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    number = {w: i for i, w in enumerate(set(chain.from_iterable(split)))}
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, total)
    doc = np.repeat(np.arange(len(split)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in split]
    change = np.zeros(total + 1, np.int64)
    for start, length, period in runs_of(words, doc, np.repeat(stop, sizes), min_length):
        d = int(doc[start])
        found[d].append((start - int(stop[d] - sizes[d]), length, period))
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    collapsed = []
    for own, a, b, runs in zip(split, (stop - sizes).tolist(), stop.tolist(), found):
        collapsed.append(b" ".join([w for w, k in zip(own, kept[a:b].tolist()) if k] if runs else own))
    return found, collapsed


def _collapse(min_length: int):
    entry = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = begin = 0
        lengths = pc.binary_length(batch.column("text").cast(pa.large_binary())).fill_null(0).to_pylist()
        for i, length in enumerate(lengths):
            if size and size + length > BLOCK_BYTES:
                yield batch.slice(begin, i - begin)
                size, begin = 0, i
            size += length
        if batch.num_rows:
            yield batch.slice(begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                found, collapsed = find_runs([t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()], min_length)
                flat = np.array(list(chain.from_iterable(found)), np.int64).reshape(-1, 3)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), runs.cast(entry), pa.array(collapsed, pa.binary()).cast(pa.string())], ["id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: `key`, runs (array of start, length, period; by start, then period), collapsed text."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(
        _collapse(min_length), f"id {id_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return made.withColumnRenamed("id", key)


def longest(runs: Column) -> Column:
    """The longest run of the column `runs`; of several the one that starts first, then the shorter period."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), (-best["l"]).alias("length"), best["period"].alias("period")))
