"""SentencePiece encoding, decoding and sampling of distinct segmentations.

`encode` gives the library's own ids and `decode` turns ids back into text. Sampling looks at all ways to
cut a text into pieces of the model: a lattice whose paths have a weight, the product of their pieces'
weights. The k best paths under Gumbel noise are k distinct segmentations drawn without replacement. They
are found by A-star search over perturbed regions of the lattice:

* a region is a set of paths; its key is the largest perturbed weight in it, a Gumbel number shifted by the
  log of the region's weight and truncated by the key of the region it was cut from;
* taking the region with the largest key gives the next path: a prefix that all its paths share, the first
  edge drawn among those the region allows, the rest drawn forward edge by edge;
* what is left of it falls apart by the first edge where a path leaves that path.

Only the k best of those parts can matter, so the queue stays short whatever the length of the text, and a
text of n pieces costs k passes over n numbers. The key of the first region not taken is the threshold that
gives every sample its inclusion probability and so its importance weight.

Lattices of words are shared: no piece of the model has a blank after a letter, so a text's lattice is the
chain of the lattices of its words, and each distinct word's edges and the library's ids of it are worked out
once per task (bounded). What is asked of all pieces of a path is worked out for a block of texts at once.

The model is a merge list: its scores are negated ranks, not log-probabilities. `log_weight` reads them as
Zipf's law, log p = -power * log(rank + OFFSET) + a constant.

Defined results
---------------
* The row key and `seed` alone decide the noise: reruns, other partitions and other batches give the same
  samples. Rows with equal keys and texts give equal samples. A null key is a key like any other.
* A null text is the empty text. An empty text has one segmentation, without pieces.
* Blanks and the model's own blank sign are the same to it, so decoding gives blanks for both, here and in
  the library. All other text comes back as it was.
* A text with fewer than k segmentations gives all it has. A character outside the vocabulary has one way
  out, its bytes.
* Texts of any length are searched whole. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.units import per_process

BLANK = "▁"
SAMPLES = 2
POWER = 1.0
OFFSET = 50.0
UNKNOWN_RANK = 200_000
BLOCK_CHARS = 1 << 19
MEMO_WORDS = 350_000


def words_of(text: str) -> list[str]:
    """The text as the model sees it, cut before each run of blanks; a blank stands before it all."""
    text = text.replace(BLANK, " ")
    if not text:
        return []
    if "  " not in text and text[-1] != " " and text[0] != " " and "\0" not in text:
        return (BLANK + text.replace(" ", "\0" + BLANK)).split("\0")
    out, run = [], BLANK
    for i, part in enumerate(text.split(" ")):
        if i:
            run += BLANK
        if part:
            out.append(run + part)
            run = ""
    return [*out, run] if run else out


class _Column:
    """A flat array that grows at its end."""

    def __init__(self, dtype: type):
        self.data = np.empty(1 << 16, dtype)
        self.size = 0

    def extend(self, values: list | np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            # Places not filled yet are not touched, so they take no memory.
            grown = np.empty(max(end, self.size * 3 // 2), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : end] = values
        self.size = end


class Words(NamedTuple):
    """A block of texts as numbers of words, valid until the next block is numbered."""

    numbers: np.ndarray
    counts: np.ndarray  # words of each text


class Lattices:
    """Edges of the words met so far: for each place in a word, the pieces that begin there.

    An edge has the probability that a random path through its node takes it, so walking forward draws
    paths by their weight. `encode` gives the library's ids of words, which are kept beside the edges.
    """

    def __init__(self, processor, encode: Callable[[list[str]], list[list[int]]], power: float = POWER, offset: float = OFFSET):
        self.encode = encode
        size = processor.get_piece_size()
        special = (processor.is_control, processor.is_unknown, processor.is_byte, processor.is_unused)
        self.pieces = {processor.id_to_piece(i): i for i in range(size) if not any(f(i) for f in special)}
        if any(BLANK in p.lstrip(BLANK) for p in self.pieces):
            raise ValueError("the model has pieces with a blank after a letter")
        self.longest = max(map(len, self.pieces))
        self.log_weight = {
            k: -power * math.log(min(max(-processor.get_score(k), 0.0), UNKNOWN_RANK) + offset) for k in self.pieces.values()}
        self.unknown = -power * math.log(UNKNOWN_RANK + offset)
        self._trie(self.log_weight)
        self.number: dict[str, int] = {}
        self.first = _Column(np.int64)  # first node of each word; a word of n characters has n nodes
        self.edge_at = _Column(np.int64)  # first edge of each node
        self.piece = _Column(np.int32)  # of each edge; outside the vocabulary: -1 - its code
        self.hop = _Column(np.int8 if self.longest < 128 else np.int32)  # characters that the edge passes
        self.logp = _Column(np.float64)
        self.stay = _Column(np.float64)  # log of the weight of the other edges at its node, -inf where there is none
        self.upto = _Column(np.float64)  # node number and the node's probability up to this edge
        self.ids = _Column(np.int32)
        self.ids_at = _Column(np.int64)  # first id of each word
        self.clear()

    def clear(self) -> None:
        self.number.clear()
        for column in (self.first, self.edge_at, self.piece, self.hop, self.logp, self.stay, self.upto, self.ids, self.ids_at):
            column.size = 0
        for column in (self.first, self.edge_at, self.ids_at):
            column.extend([0])

    def _trie(self, weights: dict[int, float]) -> None:
        """The pieces as a tree: a hash table of (node, character) and the node each leads to."""
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, int] = {}
        for piece, k in self.pieces.items():
            at = 0
            for c in piece:
                at = nodes.setdefault((at, c), len(nodes) + 1)
            ends[at] = k
        keys = np.array([(a << 21) | ord(c) for a, c in nodes], np.int64)
        leads = np.array(list(nodes.values()), np.int64)
        self.table_bits = (4 * len(keys)).bit_length()
        self.table_keys = np.full(1 << self.table_bits, -1, np.int64)
        self.table_next = np.zeros(1 << self.table_bits, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # a taken slot sends a key to the next one
            free = left[self.table_keys[slot[left]] < 0]
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.table_keys[slot[won]], self.table_next[slot[won]] = keys[won], leads[won]
            left = np.setdiff1d(left, won)
            slot[left] = (slot[left] + 1) & (len(self.table_keys) - 1)
        self.tree_piece = np.full(len(nodes) + 1, -1, np.int64)
        self.tree_piece[list(ends)] = list(ends.values())
        self.weight_of = np.zeros(max(weights) + 1)
        self.weight_of[list(weights)] = list(weights.values())

    def _slot(self, key: np.ndarray) -> np.ndarray:
        spread = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The node that each (node, character) leads to, 0 for none."""
        slot = self._slot(key)
        seen = self.table_keys[slot]
        out = np.where(seen == key, self.table_next[slot], 0)
        asking = np.flatnonzero((seen != key) & (seen >= 0))
        while len(asking):
            slot[asking] = (slot[asking] + 1) & (len(self.table_keys) - 1)
            here, wanted = slot[asking], key[asking]
            seen = self.table_keys[here]
            out[asking] = np.where(seen == wanted, self.table_next[here], 0)
            asking = asking[(seen != wanted) & (seen >= 0)]
        return out

    def _edges(self, chars: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, piece) of all pieces found at all places of the words, by place, long pieces first; first edge of each place."""
        place, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        found = []
        for length in range(1, self.longest + 1):
            node = self._find((node << 21) | chars[place + length - 1])
            here = node > 0
            if length == 1:  # every place has a way on, if only by the character's bytes
                piece = np.where(here, self.tree_piece[node], -1)
                found.append((length, place, np.where(piece < 0, -1 - chars, piece)))
            place, node = place[here], node[here]
            if length > 1:
                piece = self.tree_piece[node]
                real = piece >= 0
                found.append((length, place[real], piece[real]))
            on = room[place] > length
            place, node = place[on], node[on]
            if not len(place):
                break
        first = np.zeros(len(chars) + 1, np.int64)
        for _, at, _ in found:
            first[at + 1] += 1  # a place occurs once per length
        first = np.cumsum(first)
        free = first[:-1].copy()
        place, lengths, pieces = np.repeat(np.arange(len(chars)), np.diff(first)), np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        for length, at, piece in reversed(found):
            to = free[at]
            lengths[to], pieces[to] = length, piece
            free[at] = to + 1
        return place, lengths, pieces, first

    def words(self, texts: list[list[str]]) -> Words:
        """Numbers of all words of a block of texts; words not met yet are worked out."""
        if len(self.number) > MEMO_WORDS:
            self.clear()
        flat = list(chain.from_iterable(texts))
        numbers = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        unmet = np.flatnonzero(numbers < 0).tolist()
        if unmet:
            self._add(list(dict.fromkeys(flat[i] for i in unmet)))
            numbers[unmet] = [self.number[flat[i]] for i in unmet]
        return Words(numbers, np.fromiter(map(len, texts), np.int64, len(texts)))

    def ids_of(self, words: Words) -> list[np.ndarray]:
        """The library's ids of each text."""
        first = self.ids_at.data[: self.ids_at.size]
        sizes = np.diff(first)[words.numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(first[words.numbers] - ends[:-1], sizes) + np.arange(ends[-1])
        return np.split(self.ids.data[at], ends[np.cumsum(words.counts)][:-1]) if len(words.counts) else []

    def _add(self, new: list[str]) -> None:
        """Work out the edges of new words, place by place from their ends, all words in step."""
        chars = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in new], np.int64)
        word_end = np.repeat(np.cumsum(sizes), sizes)
        room = word_end - np.arange(len(chars))  # characters from here to the word's end
        place, length, piece, node_first = self._edges(chars, room)
        weight = np.where(piece >= 0, self.weight_of[np.maximum(piece, 0)], self.unknown)
        ahead = place + length
        ends_word = ahead == word_end[place]
        below = np.zeros(len(chars) + 1)  # log of the weight of all ways from a place to its word's end
        by_room = np.argsort(room, kind="stable")
        cuts = np.searchsorted(room[by_room], np.arange(1, int(room.max()) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = by_room[a:b]
            counts = node_first[at + 1] - node_first[at]
            firsts = np.cumsum(counts) - counts
            edge = np.repeat(node_first[at] - firsts, counts) + np.arange(int(counts.sum()))
            value = weight[edge] + np.where(ends_word[edge], 0.0, below[ahead[edge]])
            top = np.maximum.reduceat(value, firsts)
            below[at] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts)), firsts))
        logp = np.minimum(weight + np.where(ends_word, 0.0, below[ahead]) - below[place], 0.0)
        share = np.cumsum(np.exp(logp))
        share -= np.concatenate([[0.0], share])[node_first[place]]
        others = -np.expm1(logp)
        with np.errstate(divide="ignore"):
            stay = np.log(np.where(others > 1e-12, others, 0.0))
        node = self.edge_at.size - 1
        upto = node + place + np.minimum(share, 1.0)
        upto[node_first[1:] - 1] = node + np.arange(len(chars)) + 1.5  # above any draw, whatever the rounding
        self.edge_at.extend(self.piece.size + node_first[1:])
        self.first.extend(node + np.cumsum(sizes))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        for column, values in ((self.piece, piece), (self.hop, length), (self.logp, logp), (self.stay, stay), (self.upto, upto)):
            column.extend(values)
        ids = self.encode(new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids_at.extend(self.ids.size + np.cumsum(sizes))
        self.ids.extend(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(key: np.ndarray, round_: int, kind: int) -> np.ndarray:
    """Seeds by row key, round and use, for `_uniform`."""
    return _mix(key + _mix(np.array([round_ * 4 + kind + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0])


def _uniform(stream: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by seed and place in the text alone."""
    return (_mix(stream + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


class Region:
    """Paths that share a prefix of path `parent` up to `place` and do not take the `barred` edges there."""

    __slots__ = ("barred", "parent", "place")

    def __init__(self, parent: int, place: int, barred: tuple[int, ...]):
        self.parent, self.place, self.barred = parent, place, barred


class Sampler:
    """Distinct segmentations of a block of texts."""

    def __init__(self, lattices: Lattices, samples: int = SAMPLES):
        self.lattices, self.samples = lattices, samples

    def sample(self, words: Words, keys: np.ndarray) -> list[list[tuple[np.ndarray, float, float]]]:
        """For each text its samples in order: (edges, log-probability, log arrival time), and the threshold last.

        `keys` are unsigned 64-bit row keys. The arrival time of a path is exponential with its probability as
        rate; the negative log of it is the perturbed weight. The last entry has no edges: its arrival time is
        that of the first path not given, infinite where there is none.
        """
        net = self.lattices
        numbers, per_text = words
        n_texts = len(per_text)
        lengths = np.diff(net.first.data[: net.first.size])[numbers]
        word_end = np.cumsum(lengths)
        word_at = word_end - lengths  # place of each word in the block
        n_chars = int(word_end[-1]) if len(word_end) else 0
        bounds = np.concatenate([[0], word_end])[np.concatenate([[0], np.cumsum(per_text)])]  # of texts, in characters
        text_of_word = np.repeat(np.arange(n_texts), per_text)
        results: list[list] = [[] for _ in range(n_texts)]
        first_noise = np.log(-np.log(_uniform(_stream(keys, 0, 3), np.zeros(n_texts))))
        queues: list[list] = [
            [(noise, t, Region(-1, at, ()))] for t, (noise, at) in enumerate(zip(first_noise.tolist(), bounds.tolist()))]
        order = n_texts
        paths = np.full((self.samples, n_chars), -1, np.int32)  # edge taken at each place, -1 between
        for round_ in range(self.samples):
            active = [t for t in range(n_texts) if queues[t]]
            taken = {t: heapq.heappop(queues[t]) for t in active}
            start = np.full(n_texts, n_chars, np.int64)  # from here a text's path is drawn anew
            for t in active:
                start[t] = taken[t][2].place
            self._copy_prefixes(paths, round_, taken, bounds)
            # The words to walk: those behind the start, and the one that holds it, from there on.
            walk = np.flatnonzero(word_end > start[text_of_word])
            begin = np.maximum(word_at[walk], start[text_of_word[walk]])
            node = net.first.data[numbers[walk]] + begin - word_at[walk]
            barred = {int(start[t]): taken[t][2].barred for t in active if taken[t][2].barred}
            self._walk(paths[round_], node, begin, word_end[walk], _stream(keys, round_, 0)[text_of_word[walk]], bounds[:-1][text_of_word[walk]], barred)
            places = np.flatnonzero(paths[round_] >= 0)
            edges = paths[round_][places]
            logp = net.logp.data[edges]
            cuts = np.searchsorted(places, bounds)
            text = np.repeat(np.arange(n_texts), np.diff(cuts))
            # Where the path may be left: from the start on. The noise of each part, all texts in step.
            ahead = np.flatnonzero(places >= start[text])
            u = _uniform(_stream(keys, round_, 1)[text[ahead]], places[ahead] - bounds[text[ahead]])
            noise = np.log(-np.log(u))
            parts = np.searchsorted(ahead, cuts).tolist()
            cuts = cuts.tolist()
            score = noise - net.stay.data[edges[ahead]]
            for t in active:
                a, b, c, d = cuts[t], cuts[t + 1], parts[t], parts[t + 1]
                arrival, _, region = taken[t]
                upto = np.cumsum(logp[a:b])
                results[t].append((edges[a:b], float(upto[-1]) if b > a else 0.0, arrival))
                if c == d:
                    continue
                before = upto[b - a - (d - c) :] - logp[b - (d - c) : b]
                key = score[c:d] - before
                if region.barred:
                    left = self._left_over((*region.barred, int(edges[b - (d - c)])))
                    key[0] = noise[c] - before[0] - math.log(left) if left > 1e-12 else math.inf
                best = np.argpartition(key, self.samples)[: self.samples] if d - c > self.samples else np.arange(d - c)
                for i in best.tolist():
                    if key[i] < math.inf:
                        order += 1
                        at = b - (d - c) + i
                        out = (*region.barred, int(edges[at])) if i == 0 else (int(edges[at]),)
                        heapq.heappush(queues[t], (float(np.logaddexp(arrival, key[i])), order, Region(round_, int(places[at]), out)))
        for t in range(n_texts):
            results[t].append((np.zeros(0, np.int32), 0.0, queues[t][0][0] if queues[t] else math.inf))
        return results

    def _left_over(self, barred: tuple[int, ...]) -> float:
        """Weight of the edges beside these, all of one node."""
        net = self.lattices
        node = int(np.searchsorted(net.edge_at.data[: net.edge_at.size], barred[-1], side="right")) - 1
        if int(net.edge_at.data[node + 1] - net.edge_at.data[node]) == len(barred):
            return 0.0
        return max(1.0 - float(np.exp(net.logp.data[list(barred)]).sum()), 0.0)

    @staticmethod
    def _copy_prefixes(paths: np.ndarray, round_: int, taken: dict, bounds: np.ndarray) -> None:
        for t, (_, _, region) in taken.items():
            if region.parent >= 0:
                a = int(bounds[t])
                paths[round_, a : region.place] = paths[region.parent, a : region.place]

    def _walk(self, path: np.ndarray, node: np.ndarray, place: np.ndarray, end: np.ndarray, stream: np.ndarray,
              base: np.ndarray, barred: dict[int, tuple[int, ...]]) -> None:
        """Draw edges from each node to its word's end, all words in step."""
        net = self.lattices
        upto, hop, edge_at = net.upto.data, net.hop.data, net.edge_at.data
        first_step = True
        while len(node):
            u = _uniform(stream, place - base)
            # Long pieces, the likelier ones, come first, so few are asked twice; the last one always holds.
            edge, mark = edge_at[node], node + u
            on = np.flatnonzero(upto[edge] <= mark)
            while len(on):
                edge[on] += 1
                on = on[upto[edge[on]] <= mark[on]]
            if first_step and barred:
                for i in np.flatnonzero(np.isin(place, np.fromiter(barred, np.int64))):
                    edge[i] = self._other(int(node[i]), barred[int(place[i])], float(u[i]))
            first_step = False
            path[place] = edge
            step = hop[edge]
            node, place = node + step, place + step
            on = place < end
            node, place, end, stream, base = node[on], place[on], end[on], stream[on], base[on]

    def _other(self, node: int, barred: tuple[int, ...], u: float) -> int:
        """An edge of the node that is not barred, drawn by weight."""
        a, b = (int(self.lattices.edge_at.data[node + i]) for i in (0, 1))
        free = [e for e in range(a, b) if e not in barred]
        weights = np.exp(self.lattices.logp.data[free])
        return free[min(int(np.searchsorted(np.cumsum(weights), u * weights.sum(), side="right")), len(free) - 1)]


class Codec:
    """The model, its own encoding word by word, and sampling."""

    def __init__(self, model_file: str, samples: int = SAMPLES, power: float = POWER, offset: float = OFFSET):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.bytes = [self.processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.lattices = Lattices(self.processor, self._library, power, offset)
        self.sampler = Sampler(self.lattices, samples)

    def _library(self, words: list[str]) -> list[list[int]]:
        """Ids of words; the library puts the first blank there by itself."""
        plain = [w[1:].replace(BLANK, " ") for w in words]
        ids = self.processor.encode(plain, num_threads=1)
        for i, word in enumerate(plain):
            if not word or word[-1] == " ":  # blanks alone: the library sees no blank in an empty text, so something stands before
                ids[i] = self.processor.encode("a" + " " * (len(word) + 1))[len(self.processor.encode("a")):]
        return ids

    def encode(self, words: Words | list[list[str]]) -> list[np.ndarray]:
        """The library's ids of texts cut by `words_of`, or numbered by `Lattices.words`."""
        return self.lattices.ids_of(words if isinstance(words, Words) else self.lattices.words(words))

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.processor.decode([x.tolist() for x in ids], num_threads=1)

    def ids_of_paths(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """Piece ids of paths given by their edges; characters outside the vocabulary as their bytes."""
        pieces = self.lattices.piece.data[np.concatenate([np.zeros(0, np.int64), *paths]).astype(np.int64)]
        ends = np.cumsum([0, *map(len, paths)])
        outside = np.flatnonzero(pieces < 0)
        if len(outside):
            spelled = [[self.bytes[b] for b in chr(-1 - p).encode()] for p in pieces[outside].tolist()]
            counts = np.ones(len(pieces), np.int64)
            counts[outside] = [len(x) for x in spelled]
            ends = np.concatenate([[0], np.cumsum(counts)])[ends]
            pieces = np.repeat(pieces, counts)
            pieces[pieces < 0] = [i for x in spelled for i in x]
        return np.split(pieces, ends[1:-1]) if paths else []

    def sample(self, words: Words | list[list[str]], keys: list) -> list[list[dict]]:
        """Distinct segmentations of each text (as for `encode`) with log-probability, perturbed weight and inclusion score."""
        words = words if isinstance(words, Words) else self.lattices.words(words)
        seeds = np.array([xxhash.xxh3_64_intdigest(repr(k).encode()) for k in keys], np.uint64)
        out, drawn = [], self.sampler.sample(words, seeds)
        ids = iter(self.ids_of_paths([edges for found in drawn for edges, _, _ in found[:-1]]))
        for found in drawn:
            threshold = found[-1][2]
            rows = []
            for _, logp, arrival in found[:-1]:
                # A path is in the sample when it arrives before the threshold: 1 - exp(-p * time).
                log_mean = logp + threshold
                inclusion = 1.0 if log_mean > 30 else -math.expm1(-math.exp(log_mean))
                weight = logp - math.log(inclusion) if inclusion > 0 else -threshold
                rows.append({"ids": next(ids), "log_prob": logp, "perturbed": -arrival, "inclusion": inclusion, "log_weight": weight})
            out.append(rows)
        return out


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_CHARS or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


NUMBERS = ("log_prob", "perturbed", "inclusion", "log_weight")
SAMPLE_TYPE = "struct<rank:int,ids:array<int>,log_prob:double,perturbed:double,inclusion:double,log_weight:double>"


def _lists(parts: list[np.ndarray], checksums: bool) -> list[pa.Array]:
    """Arrays of ids as one Arrow column of lists, and with `checksums` the length and CRC-32 of each."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *parts]).astype("<i4", copy=False)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
    if not checksums:
        return [lists]
    sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return [lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())]


def _run(model_file: str, samples: int, power: float, offset: float, seed: str, checksums: bool):
    ids_names = ["ids", "n_pieces", "ids_crc32"] if checksums else ["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_process(("pieces", model_file, samples, power, offset), lambda: Codec(model_file, samples, power, offset))
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("id"))
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            for a, b in _blocks(texts):
                block, part = texts[a:b], keys.slice(a, b - a)
                words = codec.lattices.words([words_of(t) for t in block])
                ids = codec.encode(words)
                back = codec.decode(ids)
                whole = [x == t.replace(BLANK, " ") for x, t in zip(back, block)]
                drawn = codec.sample(words, [(seed, k) for k in part.to_pylist()])
                flat = list(chain.from_iterable(drawn))
                ranks = [i + 1 for found in drawn for i in range(len(found))]
                columns = [pa.array(ranks, pa.int32()), *_lists([r["ids"] for r in flat], checksums), *(pa.array([r[c] for r in flat], pa.float64()) for c in NUMBERS)]
                ends = np.cumsum([0, *map(len, drawn)]).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["rank", *ids_names, *NUMBERS]))
                yield pa.RecordBatch.from_arrays([part, *_lists(ids, checksums), pa.array(whole), held], ["id", *ids_names, "round_trip", "samples"])

    return run


def encode_and_sample(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", samples: int = SAMPLES,
                      power: float = POWER, offset: float = OFFSET, seed: str = "pieces", checksums: bool = False) -> DataFrame:
    """One row per document: `key`, ids (the library's), round_trip, samples.

    `samples` are distinct segmentations with rank, ids, log_prob, perturbed weight, inclusion (probability
    of being in the sample given the threshold) and log_weight (importance weight, log). With `checksums` all ids
    are followed by their number and CRC-32 (little-endian unsigned 32-bit integers).
    `model_file` is a path that exists on every executor.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, ids array<int>, round_trip boolean, samples array<{SAMPLE_TYPE}>"
    if checksums:
        schema = schema.replace("ids array<int>", "ids array<int>, n_pieces bigint, ids_crc32 bigint")
        schema = schema.replace("ids:array<int>", "ids:array<int>,n_pieces:bigint,ids_crc32:bigint")
    return rows.mapInArrow(_run(model_file, samples, power, offset, seed, checksums), schema).withColumnRenamed("id", key)


def _decode(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x or [] for x in part.column(part.schema.get_field_index("ids")).to_pylist()]
                text = pa.array(processor.decode(ids, num_threads=1) if ids else [], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("id")), text], ["id", "text"])

    return run


def decode_ids(rows: DataFrame, model_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids; null ids are no ids and give the empty text."""
    narrow = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{ids}`").alias("ids"))
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(_decode(model_file), f"id {id_type}, text string").withColumnRenamed("id", key)
