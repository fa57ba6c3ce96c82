"""Periodic runs of words, found online by catchers over dyadic blocks (after Jansson and Peng, "An online algorithm for
finding squares in a string", and Apostolico and Breslauer).

A run is a stretch of consecutive words with smallest period q, at least twice as long as q and at least ``min_length``, that no
neighbouring word extends keeping period q. Words are what lies between ASCII white space.

Method. A square of period q has in its first half a whole aligned block of b words, for the power of two b with
2b - 1 <= q < 4b - 1. Of every completed block a catcher keeps the hash. With each appended word the text's last b words are
compared with the two catchers of level b that can still be q words behind; a hit opens a comparison of the text with
itself shifted by q, which is followed to both sides word by word. Where it agrees on q words there is a square; the
squares of one stretch are one run. A comparison that reaches the end of what has been appended stays open and goes on with the
next words. Of equal stretches with several periods the smallest counts (the others are its multiples). Hits inside a run already
found, at a multiple of its period, are dropped: they can only give that run again.

``append`` takes any number of words and works on them level by level in arrays, so that a text appended whole and one appended
word by word give the same runs. A catcher set holds the words as numbers, two numbers per word for the runs covering
it, and about one hash per word for the levels: some 30 bytes a word however long the text, besides its distinct words. Tasks take
short texts together, told apart by numbers that occur once, and very long ones alone. Nothing is shuffled.

Null and empty texts, and those without a word, have no runs; their collapsed text is empty. Repeated rows, and null ids, are
documents of their own. An empty table gives an empty table. Extra columns stay as they are; the new columns ``n_words``, ``runs``
and ``collapsed`` replace old ones of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripmart.llm.common import pieces, schema_with, with_columns

MIN_LENGTH = 12
#: Words appended at a time, and bytes split into words at a time: bounds of working memory, without influence on results.
APPENDED, SPLIT_BYTES = 1 << 17, 1 << 18
_SPACE = regex.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FOLD = np.uint64(29)

Run = tuple[int, int, int]


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring blocks from their hashes; order counts."""
    mixed = (left * _ODD[0]) ^ (right + _ODD[1])
    mixed ^= mixed >> _FOLD
    mixed *= _ODD[1]
    return mixed ^ (mixed >> _FOLD)


class _Level:
    """Blocks of ``block`` words: their catchers, and the hashes that the level above still needs."""

    def __init__(self, block: int):
        self.block = block
        self.next = 0  # position of the next hash
        self.tail = np.empty(0, np.uint64)  # hashes of the positions before it
        self.first, self.catchers = 0, np.empty(0, np.uint64)  # number of the first catcher kept, and their hashes

    def hits(self, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes the hashes of the next positions. Returns starts of blocks and the distance at which each occurs again."""
        b, start = self.block, self.next
        at = np.arange(start, start + len(fresh))
        begin = -(-start // b) * b
        self.catchers = np.concatenate([self.catchers, fresh[begin - start :: b]])
        newest = (at - (2 * b - 1)) // b
        blocks, shifts = [], []
        for number in (newest, newest - 1):
            kept = number >= self.first
            same = np.flatnonzero(kept)[self.catchers[number[kept] - self.first] == fresh[kept]]
            blocks.append(number[same] * b)
            shifts.append(at[same] - number[same] * b)
        self.next += len(fresh)
        self.tail = np.concatenate([self.tail, fresh])[-b:]
        spent = max(0, (self.next - (2 * b - 1)) // b - 1 - self.first)
        self.first, self.catchers = self.first + spent, self.catchers[spent:]
        return np.concatenate(blocks), np.concatenate(shifts)


class SquareCatcher:
    """Runs of a growing sequence of numbers. ``longest`` bounds the length of a run, where it is known: texts that lie one after
    the other need no catchers for periods beyond half the longest."""

    def __init__(self, min_length: int = MIN_LENGTH, longest: int | None = None):
        self.min_length, self.longest = min_length, longest
        self.n = 0
        self._words = np.empty(1024, np.int64)
        self._covered_to = np.empty(0, np.int64)  # end and period of the farthest run known to cover a position
        self._period = np.empty(0, np.int64)
        self._levels = [_Level(1)]
        self._found: dict[tuple[int, int], int] = {}
        self._open: dict[tuple[int, int], None] = {}  # (shift, start) of comparisons that agree up to the end

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        before, self.n = self.n, self.n + len(words)
        if self.n > len(self._words):
            room = np.empty(max(self.n, 2 * len(self._words)), np.int64)
            room[:before] = self._words[:before]
            self._words = room
        self._words[before : self.n] = words
        self._covered_to = np.concatenate([self._covered_to, np.zeros(len(words), np.int64)])
        self._period = np.concatenate([self._period, np.ones(len(words), np.int64)])
        for shift, start in list(self._open):
            del self._open[shift, start]
            self._follow(shift, before - shift, start)
        fresh = words.astype(np.int64).view(np.uint64) * _ODD[1]
        fresh ^= fresh >> _FOLD
        b = 1
        for depth in range(64):
            if depth == len(self._levels):
                self._levels.append(_Level(b))
            level, below = self._levels[depth], (self._levels[depth].next, self._levels[depth].tail)
            if len(fresh):
                self._take(*level.hits(fresh), b)
            # hashes of the level above: position p joins the blocks at p and p + b
            known = np.concatenate([below[1], fresh])
            origin = below[0] - len(below[1])
            b *= 2
            wanted = 0 if depth + 1 == len(self._levels) else self._levels[depth + 1].next
            if self.n < b or (self.longest is not None and 2 * b - 1 > self.longest // 2):
                break
            known = known[wanted - origin :]
            fresh = _join(known[: max(0, self.n - b + 1 - wanted)], known[b // 2 :])

    def runs(self) -> list[Run]:
        """(start, length, period) of every run so far, by start and then period."""
        found = dict(self._found)
        for (shift, start), _ in self._open.items():
            self._note(found, start, self.n, shift)
        return sorted((s, e - s, q) for (s, e), q in found.items())

    def _take(self, blocks: np.ndarray, shifts: np.ndarray, b: int) -> None:
        """Follow what hits found: chains of neighbouring blocks with one shift first, which are one comparison."""
        known = (self._covered_to[blocks] >= blocks + shifts + b) & (shifts % self._period[blocks] == 0)
        blocks, shifts = blocks[~known], shifts[~known]
        if not len(blocks):
            return
        order = np.lexsort((blocks, shifts))
        blocks, shifts = blocks[order], shifts[order]
        head = np.concatenate(([True], (shifts[1:] != shifts[:-1]) | (blocks[1:] != blocks[:-1] + b)))
        starts = np.flatnonzero(head)
        q, s = shifts[starts], blocks[starts]
        e = blocks[np.concatenate((starts[1:], [len(blocks)])) - 1] + b
        # neighbours of a chain are no hits, so it grows by less than a block to each side
        long_enough = e - s + 2 * (b - 1) >= np.maximum(q, self.min_length - q)
        # at the end of the text the blocks to come are unknown
        q, s, e = (x[long_enough | (e + q + b > self.n)] for x in (q, s, e))
        s, e = self._grow(q, s, e, b)
        whole = (e - s >= np.maximum(q, self.min_length - q)) | (e + q == self.n)
        for shift, start in zip(q[whole].tolist(), s[whole].tolist(), strict=True):
            if self._covered_to[start] < start + 2 * shift or shift % self._period[start]:
                self._follow(shift, start, None)

    def _grow(self, q: np.ndarray, s: np.ndarray, e: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Agreeing stretches grown word by word to both sides, all at once, by a block at most."""
        x = self._words
        for stretch, step in ((s, -1), (e, 1)):
            going = np.arange(len(q))
            for _ in range(b):
                at = stretch[going] - (step < 0)
                going, at = going[inside := (at >= 0) & (at + q[going] < self.n)], at[inside]
                going = going[x[at] == x[at + q[going]]]
                if not len(going):
                    break
                stretch[going] += step
        return s, e

    def _agrees(self, shift: int, at: int, step: int) -> int:
        """How far from ``at`` the text agrees with itself shifted, in ever larger slices."""
        x, size, end = self._words, 64, self.n - shift
        while 0 < at if step < 0 else at < end:
            a, b = (max(0, at - size), at) if step < 0 else (at, min(end, at + size))
            differ = np.flatnonzero(x[a:b] != x[a + shift : b + shift])
            if len(differ):
                return a + int(differ[-1]) + 1 if step < 0 else a + int(differ[0])
            at, size = (a if step < 0 else b), min(2 * size, 1 << 16)
        return at

    def _follow(self, shift: int, at: int, start: int | None) -> None:
        """The whole stretch around ``at`` in which the text agrees with itself shifted; ``start`` where it is known."""
        if start is None:
            start = self._agrees(shift, at, -1)
        end = self._agrees(shift, at, 1) + shift
        if end == self.n:  # the next word may go on
            self._open[shift, start] = None
        else:
            self._note(self._found, start, end, shift)
        if end - start >= 2 * shift:
            part = slice(start, end)
            reach = self._covered_to[part]
            better = reach < end
            self._period[part][better] = shift
            reach[better] = end

    def _note(self, found: dict, start: int, end: int, shift: int) -> None:
        if end - start >= max(self.min_length, 2 * shift):
            found[start, end] = min(shift, found.get((start, end), shift))


def dropped(n: int, runs: list[Run]) -> np.ndarray:
    """For each word whether some run contains it after the run's first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + SPLIT_BYTES)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


class _Numbers(dict):
    """Numbers words as they are met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def text_runs(texts: list[bytes], min_length: int = MIN_LENGTH) -> tuple[list[int], list[list[Run]], list[bytes]]:
    """Of each text its number of words, its runs, and the kept words joined by blanks."""
    numbers = _Numbers()
    coded = []
    for text in texts:
        parts = [np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) for part in _parts(text)]
        coded.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
    counts = [len(c) for c in coded]
    catcher = SquareCatcher(min_length, max(counts, default=0))
    starts, at = [], 0
    for i, words in enumerate(coded):
        starts.append(at)
        at += len(words) + 1
        coded[i] = np.append(words, -1 - i)  # a number of its own ends each text
    joined = np.concatenate(coded) if coded else np.empty(0, np.int64)
    del coded, numbers
    for cut in range(0, len(joined), APPENDED):
        catcher.append(joined[cut : cut + APPENDED])
    runs: list[list[Run]] = [[] for _ in texts]
    bounds = np.array(starts)
    for start, length, period in catcher.runs():
        i = int(np.searchsorted(bounds, start, "right")) - 1
        runs[i].append((start - starts[i], length, period))
    collapsed = []
    for text, n, found in zip(texts, counts, runs, strict=True):
        gone = dropped(n, found) if found else None
        out, at = [], 0
        for part in _parts(text):
            if gone is not None:
                keep = ~gone[at : at + len(part)]
                at += len(part)
                part = list(compress(part, keep.tolist()))
            if part:
                out.append(b" ".join(part))
        collapsed.append(b" ".join(out))
    return counts, runs, collapsed


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The documents with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the text without
    the words that repeat a run's first period, in place of the text."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in pieces(batches, text_col):
            texts = [t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            counts, runs, collapsed = text_runs(texts, min_length)
            rest = batch.select([n for n in batch.schema.names if n != text_col])
            yield with_columns(
                rest,
                n_words=pa.array(counts, pa.int64()),
                runs=pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], run_type),
                collapsed=pa.array(collapsed, pa.binary()).cast(pa.string()),
            )

    kind = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return docs.mapInArrow(run, schema_with(docs.drop(text_col), n_words="bigint", runs=kind, collapsed="string"))
