"""A minimal acyclic word automaton in one flat file that tasks map into memory.

Words are bytes. States with the same future are one state (shared suffixes), found while the sorted words are added
(Daciuk et al., "Incremental Construction of Minimal Acyclic Finite-State Automata", 2000). Every edge carries the number of
words that come before it in its state, so the sum along a word's path is the word's place in order, and that selects its
output ids. Many words are looked up at once: all advance by a byte together.

File: magic, five counts, then arrays of little-endian integers: edge keys (state * 256 + byte, ascending), edge targets,
edge sums, final flags, bounds of the outputs, outputs.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable

import numpy as np

MAGIC = b"TMLEX001"


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of words with their ids. Words must be distinct and not empty; order does not matter."""
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    words_below: list[int] = []

    def settle(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            words_below.append(final + sum(words_below[t] for _, t in edges))
        return register[key]

    path: list[list] = [[False, []]]  # the states of the last word that are still open
    last = b""
    for word, _ in entries:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, edges)))
        for _ in word[same:]:
            path.append([False, []])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        final, edges = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(final, edges)))
    root = settle(*path[0])

    keys, targets, sums = [], [], []
    order = [root] + [s for s in range(len(states)) if s != root]  # the root is state 0
    number = {s: i for i, s in enumerate(order)}
    for s in order:
        final, edges = states[s]
        before = int(final)
        for byte, target in edges:
            keys.append(number[s] * 256 + byte)
            targets.append(number[target])
            sums.append(before)
            before += words_below[target]
    finals = [states[s][0] for s in order]
    bounds = np.cumsum([0] + [len(ids) for _, ids in entries])
    outputs = [i for _, ids in entries for i in ids]
    parts = [
        np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(sums, "<i4"), np.array(finals, "<i4"),
        np.array(bounds, "<i4"), np.array(outputs, "<i4"),
    ]
    head = struct.pack("<8s4q", MAGIC, len(keys), len(finals), len(bounds), len(outputs))
    return head + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from its file: workers of one machine share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        magic, edges, states, bounds, outputs = struct.unpack_from("<8s4q", self._map)
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = struct.calcsize("<8s4q")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            array = np.frombuffer(self._map, kind, n, at)
            at += array.nbytes
            return array

        self.keys, self.targets, self.sums = take("<i8", edges), take("<i4", edges), take("<i4", edges)
        self.finals, self.bounds, self.outputs = take("<i4", states), take("<i4", bounds), take("<i4", outputs)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the sorted words, -1 for words not in the lexicon."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        place = np.zeros(n, np.int64)
        state = np.zeros(n, np.int64)
        live = np.flatnonzero(lengths > 0) if len(self.keys) else np.empty(0, np.int64)
        done = np.zeros(n, bool)
        depth = 0
        while len(live):
            key = state[live] * 256 + flat[starts[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            live, edge = live[hit], edge[hit]
            place[live] += self.sums[edge]
            state[live] = self.targets[edge]
            depth += 1
            over = lengths[live] == depth
            done[live[over]] = self.finals[state[live[over]]] == 1
            live = live[~over]
        return np.where(done, place, -1)

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """Ids of each word, None for words not in the lexicon."""
        places = self.places(words).tolist()
        bounds, outputs = self.bounds, self.outputs
        return [None if p < 0 else outputs[bounds[p] : bounds[p + 1]].tolist() for p in places]
