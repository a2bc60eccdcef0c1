"""Weighted acyclic automata over words, levelled and deterministic: the weight of a word sequence is a count.

States lie on levels; arcs of a level lead from a state to one of the next, sorted by state and word, and carry a label
(the place of a word in the sorted list `words`), a weight (the count of the sequence that ends with the arc) and a target.
An automaton is built from sequences in sorted order: a new state begins where a sequence leaves the path of the one before
it. From the last level up, states whose outgoing arcs are equal in labels, weights and targets become one.

Union sums weights, and filters or cuts work on the paths level by level; all with arrays, without a step per state.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from martloom.llm.texts import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Level:
    """Arcs: from state `parent[i]` by word `label[i]` with `weight[i]` to state `target[i]` of the next level."""

    def __init__(self, parent: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray):
        self.parent, self.label, self.weight, self.target = parent, label, weight, target


class Automaton:
    """`words`: sorted, bytes. Level 0 starts in state 0."""

    def __init__(self, words: list[bytes], levels: list[Level]):
        self.words, self.levels = words, levels

    @classmethod
    def from_trie(cls, words: list[bytes], parents: list[np.ndarray], labels: list[np.ndarray], weights: list[np.ndarray]) -> Automaton:
        """From the distinct prefixes of sorted sequences: entry i of a level is the prefix parents[i] of the level
        before, lengthened by labels[i]. Entries are sorted by (parent, label). Equal states are then made one."""
        levels: list[Level] = []
        kind_below = np.zeros(0, dtype=np.int64)  # state of the next level for each entry of this level
        for depth in reversed(range(len(labels))):
            parent, label, weight = parents[depth], labels[depth], weights[depth]
            n_states = len(labels[depth - 1]) if depth else 1
            target = kind_below if depth + 1 < len(labels) else np.zeros(len(label), dtype=np.int64)
            arcs = mix(label.astype(np.uint64) * _ODD + np.uint64(1)) + mix(weight.astype(np.uint64) * _ODD + np.uint64(2)) * _ODD
            arcs = mix(arcs + mix(target.astype(np.uint64) + np.uint64(3)))
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(arcs)])
            ends = np.searchsorted(parent, np.arange(n_states + 1))
            _, first, kind = np.unique(sums[ends[1:]] - sums[ends[:-1]], return_index=True, return_inverse=True)
            keep = np.zeros(n_states, dtype=bool)
            keep[first] = True
            at = np.flatnonzero(keep[parent])
            order = np.lexsort((label[at], kind[parent[at]]))
            at = at[order]
            levels.append(Level(kind[parent[at]], label[at], weight[at], target[at]))
            kind_below = kind
        return cls(words, levels[::-1])

    def paths(self) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Parents, labels and weights of all prefixes, level by level and sorted: what from_trie takes."""
        parents, labels, weights = [], [], []
        states = np.zeros(1, dtype=np.int64)
        for level in self.levels:
            low, high = np.searchsorted(level.parent, states), np.searchsorted(level.parent, states, side="right")
            counts = high - low
            parent = np.repeat(np.arange(len(states)), counts)
            arcs = np.arange(len(parent)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
            parents.append(parent)
            labels.append(level.label[arcs])
            weights.append(level.weight[arcs])
            states = level.target[arcs]
        return parents, labels, weights

    def to_bytes(self) -> bytes:
        parts = [np.array([len(self.levels), *[len(lv.label) for lv in self.levels]], dtype=np.int64).tobytes()]
        for level in self.levels:
            # parents ascend, so their steps are small
            for a in (np.diff(level.parent, prepend=0), level.label, level.weight, level.target):
                kind = np.min_scalar_type(int(a.max(initial=0)))
                parts += [bytes([kind.itemsize]), a.astype(kind).tobytes()]
        lengths = np.fromiter(map(len, self.words), dtype=np.uint32, count=len(self.words))
        raw = b"".join([*parts, len(self.words).to_bytes(8, "little"), lengths.tobytes(), *self.words])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
        n = int.from_bytes(raw[:8], "little")
        at, levels = 8 * (n + 1), []
        for size in np.frombuffer(raw, dtype=np.int64, count=n, offset=8).tolist():
            arrays = []
            for _ in range(4):
                kind = np.dtype(f"u{raw[at]}")
                arrays.append(np.frombuffer(raw, dtype=kind, count=size, offset=at + 1).astype(np.int64))
                at += 1 + size * kind.itemsize
            levels.append(Level(np.cumsum(arrays[0]), *arrays[1:]))
        n = int.from_bytes(raw[at : at + 8], "little")
        edges = at + 8 + 4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, dtype=np.uint32, count=n, offset=at + 8), dtype=np.int64)])
        return cls([raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], levels)


class Trie:
    """All prefixes of a set of sequences, level by level: parents, labels, weights, and the sorted words of the labels."""

    def __init__(self, words: list[bytes], parents: list[np.ndarray], labels: list[np.ndarray], weights: list[np.ndarray]):
        self.words, self.parents, self.labels, self.weights = words, parents, labels, weights

    @classmethod
    def union(cls, automata: list[Automaton]) -> Trie:
        """The paths of all automata, weights of equal paths summed."""
        words = sorted(set().union(*[a.words for a in automata]))
        place = {w: i for i, w in enumerate(words)}
        depth = max((len(a.levels) for a in automata), default=0)
        opened = []
        for a in automata:
            global_label = np.fromiter((place[w] for w in a.words), dtype=np.int64, count=len(a.words))
            parents, labels, weights = a.paths()
            opened.append((parents, [global_label[x] for x in labels], weights))
        states = [np.zeros(1, dtype=np.int64) for _ in automata]
        out: tuple[list, list, list] = ([], [], [])
        width = max(len(words), 1)
        for d in range(depth):
            keys = [s[p[d]] * width + lab[d] if d < len(lab) else np.zeros(0, dtype=np.int64) for s, (p, lab, _) in zip(states, opened)]
            sums = [w[d] if d < len(w) else np.zeros(0, dtype=np.int64) for _, _, w in opened]
            found, where = np.unique(np.concatenate(keys), return_inverse=True)
            weight = np.zeros(len(found), dtype=np.int64)
            np.add.at(weight, where, np.concatenate(sums))
            for part, values in zip(out, (found // width, found % width, weight)):
                part.append(values)
            edges = np.cumsum([0, *map(len, keys)])
            states = [where[edges[i] : edges[i + 1]] for i in range(len(automata))]
        return cls(words, *out)

    @classmethod
    def grown(cls, words: list[bytes], columns: list[np.ndarray], amounts: list[np.ndarray]) -> Trie:
        """From sequences: columns[d] has the label of every sequence at depth d, -1 behind its end, and amounts[d] what
        it adds to the weight of its prefix that ends there."""
        width = max(len(words), 1)
        states, live = np.zeros(len(columns[0]), dtype=np.int64), np.arange(len(columns[0]))
        out: tuple[list, list, list] = ([], [], [])
        for column, amount in zip(columns, amounts):
            live = live[column[live] >= 0]
            found, where = np.unique(states[live] * width + column[live], return_inverse=True)
            weight = np.zeros(len(found), dtype=np.int64)
            np.add.at(weight, where, amount[live])
            states[live] = where
            for part, values in zip(out, (found // width, found % width, weight)):
                part.append(values)
        return cls(words, *out)

    @classmethod
    def of(cls, sequences: list[list[bytes]], weights: np.ndarray) -> Trie:
        words = sorted(set().union(*sequences))
        place = {w: i for i, w in enumerate(words)}
        sizes = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
        depth = int(sizes.max(initial=1))
        columns = [np.fromiter((place[s[d]] if d < len(s) else -1 for s in sequences), dtype=np.int64, count=len(sequences)) for d in range(depth)]
        return cls.grown(words, columns, [np.where(sizes == d + 1, weights, 0) for d in range(depth)])

    def entries_before(self, key: list[bytes]) -> list[int]:
        """How many prefixes on each level come before a sequence (a prefix comes before what it begins)."""
        out, low, high, on_path = [], 0, len(self.labels[0]), True
        for d in range(len(self.labels)):
            if d:
                if on_path:  # children of the prefix that the key begins with
                    low, high = np.searchsorted(self.parents[d], [node, node + 1])
                else:
                    low = high = int(np.searchsorted(self.parents[d], out[-1]))
            at = int(low)
            if on_path and d < len(key):
                spot = bisect_left(self.words, key[d])
                at = int(low + np.searchsorted(self.labels[d][low:high], spot))
                on_path = at < high and spot < len(self.words) and self.words[spot] == key[d] and self.labels[d][at] == spot
                node = at
                out.append(at + (on_path and d + 1 < len(key)))
                on_path = on_path and d + 1 < len(key)
            else:
                on_path = False
                out.append(at)
        return out

    def cut(self, boundaries: list[list[bytes]]) -> Iterator[tuple[int, Trie]]:
        """The parts between boundaries (sorted sequences), with their numbers; parts without weight are left out."""
        edges = np.array([[0] * len(self.labels), *map(self.entries_before, boundaries), [len(x) for x in self.labels]])
        for number, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            a, b = low.copy(), high.copy()  # with the prefixes that lead to the part
            for d in reversed(range(1, len(a))):
                if a[d] < b[d]:
                    first, last = self.parents[d][a[d]], self.parents[d][b[d] - 1] + 1
                    a[d - 1], b[d - 1] = (min(a[d - 1], first), max(b[d - 1], last)) if a[d - 1] < b[d - 1] else (first, last)
            parents, labels, weights = [], [], []
            for d in range(len(a)):
                inside = np.arange(a[d], b[d])
                weights.append(np.where((inside >= low[d]) & (inside < high[d]), self.weights[d][a[d] : b[d]], 0))
                labels.append(self.labels[d][a[d] : b[d]])
                parents.append(self.parents[d][a[d] : b[d]] - (a[d - 1] if d else 0))
            if any(w.any() for w in weights):
                used = np.unique(np.concatenate(labels))
                yield number, Trie([self.words[i] for i in used.tolist()], parents, [np.searchsorted(used, x) for x in labels], weights)

    def minimal(self) -> Automaton:
        return Automaton.from_trie(self.words, self.parents, self.labels, self.weights)

    def sequences(self, depth: int) -> list[np.ndarray]:
        """The labels of the prefixes that end on a level, as columns from the first word on."""
        columns, at = [], np.arange(len(self.labels[depth]))
        for d in reversed(range(depth + 1)):
            columns.append(self.labels[d][at])
            at = self.parents[d][at]
        return columns[::-1]

    def look_up(self, sequences: list[list[bytes]]) -> np.ndarray:
        """Composition with an acceptor of the given sequences: their weights, 0 for those that lead nowhere."""
        place = {w: i for i, w in enumerate(self.words)}
        found = np.zeros(len(sequences), dtype=np.int64)
        at, live = np.zeros(len(sequences), dtype=np.int64), np.arange(len(sequences))
        width = max(len(self.words), 1)
        for d in range(len(self.labels)):
            live = live[np.fromiter((len(sequences[i]) > d for i in live.tolist()), dtype=bool, count=len(live))]
            labels = np.fromiter((place.get(sequences[i][d], -1) for i in live.tolist()), dtype=np.int64, count=len(live))
            live, labels = live[labels >= 0], labels[labels >= 0]
            arcs = self.parents[d] * width + self.labels[d]  # ascending
            keys = at[live] * width + labels
            spot = np.minimum(np.searchsorted(arcs, keys), max(len(arcs) - 1, 0))
            hit = arcs[spot] == keys if len(arcs) else np.zeros(len(keys), dtype=bool)
            live, spot = live[hit], spot[hit]
            at[live] = spot
            ended = np.fromiter((len(sequences[i]) == d + 1 for i in live.tolist()), dtype=bool, count=len(live))
            found[live[ended]] = self.weights[d][spot[ended]]
        return found
