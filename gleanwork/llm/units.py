"""A bounded memo of the encodings of text pieces that a tokenizer treats on their own.

A tokenizer spends most of its time on words it has met before. The ids of each distinct piece are kept in
one flat array, and a text is put together from its pieces by index, without a Python object per id. The
memo is emptied when it holds `limit` pieces: nothing is lost, pieces are encoded again.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """What `make` gives, once per Python worker process: the tasks a worker runs share its memos."""
    home = sys.modules.setdefault("_gleanwork_worker", types.ModuleType("_gleanwork_worker"))
    held = home.__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


class Memo:
    """Ids of pieces.

    `encode` turns a list of pieces into lists of ids. `split` may cut a piece further into parts that
    the tokenizer treats on their own as well; parts are pieces like others.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int, split: Callable[[str], list[str]] | None = None):
        self.encode, self.limit, self.split = encode, limit, split
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _put(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        k, end = len(self.number), self.used + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)])
        if k + len(pieces) > len(self.starts):
            more = max(len(self.starts), len(pieces))
            self.starts, self.sizes = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.starts, self.sizes))
        self.ids[self.used : end] = ids
        self.starts[k : k + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[k : k + len(pieces)] = sizes
        self.number.update(zip(pieces, range(k, k + len(pieces))))
        self.used = end

    def _add(self, new: list[str]) -> None:
        whole, cut = new, []
        if self.split:
            parts = [self.split(p) for p in new]
            cut = [(p, x) for p, x in zip(new, parts) if len(x) > 1]
            whole = list(set(chain.from_iterable(parts)).difference(self.number))
        if whole:
            ids = self.encode(whole)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._put(whole, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)
        if cut:
            self._put([p for p, _ in cut], *self._gather([x for _, x in cut]))

    def _gather(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        pieces = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, int(pieces.sum()))
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pieces)])]
        return self.ids[at], np.diff(bounds)

    def ids_of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (lists of pieces), flat, and how many each has."""
        if len(self.number) >= self.limit:
            self._clear()
        new = set(chain.from_iterable(texts)).difference(self.number)
        if new:
            self._add(list(new))
        return self._gather(texts)
