"""Document fingerprints from improbable features (after Roussev, "Data Fingerprinting with Similarity Digests", 2010).

Every window of 64 bytes of the UTF-8 of a text has an entropy. Windows of typical entropy are common to all prose; the
further from it, the rarer, and windows of almost no entropy say nothing and are left out. A window is a feature if it is the
rarest (the leftmost of equals) of at least POPULAR of the 64-window stretches around it. A text of few such windows is looked at
more finely: below 1,024 bytes windows of 16 bytes are features by the same rule in stretches of 16, from 512 bytes on those of 64 as
well, and below 128 bytes those of 8 too, so that a text and its edit share a scale where the edit changes its length. Features, without repeats, go into
a chain of Bloom filters of 2048 bits, 160 features each. The fingerprint is the filters in hexadecimal, joined by ``-``.

Likeness takes the chain of fewer features, finds for each of its filters the best partner in the other, and counts common
bits beyond those expected by chance, relative to a full match; filters weigh by their features. Equal texts have equal
fingerprints and likeness 1.

A text too short for a feature is one feature as a whole; null and empty have an empty fingerprint, like another empty one to
1 and anything else to 0. Repeated rows have equal fingerprints. Extra columns stay; the new column replaces one of its name.
An empty table gives an empty one. A task works through many texts at once in pieces of bounded size; a longer text is read in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import PIECE_BYTES, pieces, schema_with, with_columns
from tripmart.workspace import materialise

LEVELS = 1000
FILTER_BITS, FILTER_FEATURES, FILTER_HASHES = 2048, 160, 5
_SCALE = 1 << 20
_NEVER = np.int64(1 << 62)


class Scale:
    """Windows of so many bytes: the entropy of a prose window in thousandths of the most possible, the least that may be a feature, and
    in how many stretches a feature must be the rarest; for texts of at least ``shortest`` and less than ``longest`` bytes."""

    def __init__(self, window: int, typical: int, floor: int, popular: int, shortest: int, longest: int | None):
        self.window, self.popular, self.shortest, self.longest = window, popular, shortest, longest
        # what the c-th occurrence of a byte in a window adds to the sum of c log2 c, scaled to integers
        c = np.arange(window + 1, dtype=float)
        total = np.rint(np.where(c > 0, c * np.log2(np.maximum(c, 1)), 0) * _SCALE).astype(np.int64)
        self.cost = np.concatenate(([0], np.diff(total)))
        # the rank of each entropy level, 0 the rarest
        distance = np.abs(np.arange(LEVELS + 1) - typical)
        self.ranks = np.where(np.arange(LEVELS + 1) < floor, LEVELS + 1, distance.max() - distance)
        self.most = (window.bit_length() - 1) * window * _SCALE

    def takes(self, size: int) -> bool:
        return self.shortest <= size and (self.longest is None or size < self.longest)


LONG = Scale(64, typical=680, floor=150, popular=16, shortest=512, longest=None)
SHORT = Scale(16, typical=850, floor=300, popular=4, shortest=0, longest=1024)
TINY = Scale(8, typical=950, floor=300, popular=1, shortest=0, longest=128)


def window_ranks(data: np.ndarray, scale: Scale = LONG) -> np.ndarray:
    """The rank of the window at each position of a byte array, but for the last ones, where no window begins."""
    n, window = len(data), scale.window
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (n + window) + order
    ahead = np.searchsorted(key, key + (window - 1), side="right")  # where the same byte is out of the window
    place = np.arange(n)
    left = place - np.cumsum(np.bincount(ahead, minlength=n + 1))[:n] + 1  # the byte up to here, in the window that ends here
    gain, loss = np.empty(n, np.int64), np.empty(n, np.int64)
    gain[order] = scale.cost[left]
    loss[order] = scale.cost[ahead - place]
    total = np.cumsum(gain)[window - 1 :] - np.concatenate(([0], np.cumsum(loss)))[: n - window + 1]
    return scale.ranks[np.clip((scale.most - total) * LEVELS // scale.most, 0, LEVELS)]


def _windows(texts: list[bytes], scale: Scale) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, 64-bit hash) of each chosen window, in order of text and position."""
    window = scale.window
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    gap = b"\0" * window  # no stretch reaches from one text into another
    data = np.frombuffer(b"".join(t + gap for t in texts), np.uint8)
    starts = np.cumsum(sizes + window) - (sizes + window)
    owner = np.repeat(np.arange(len(texts)), sizes + window)
    valid = np.arange(len(data)) - starts[owner] + window <= sizes[owner]
    ranks = np.full(len(data), _NEVER)
    if valid.any():
        own = window_ranks(data, scale)
        usable = np.flatnonzero(valid[: len(own)] & (own <= LEVELS))
        ranks[usable] = (own[usable] << np.int64(40)) + usable  # the leftmost of equal ranks is the least
    least, span = ranks, 1
    while span < window:
        least = np.minimum(least, np.concatenate([least[span:], np.full(span, _NEVER)]))
        span *= 2
    won = least[valid & (least < _NEVER)] & np.int64((1 << 40) - 1)
    chosen = np.flatnonzero(np.bincount(won, minlength=1) >= scale.popular)
    words = data[chosen[:, None] + np.arange(window)].view("<u8") if len(chosen) else np.empty((0, window // 8), np.uint64)
    mixed = np.zeros(len(chosen), np.uint64)
    for k in range(window // 8):
        mixed = (mixed ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return owner[chosen], chosen - starts[owner[chosen]], mixed


def _block_windows(text: bytes, block: int) -> np.ndarray:
    """The hashes of the chosen long windows of a long text, those that begin in one block at a time. What chooses them are the
    stretches that hold them: they begin less than a window before the block, and end less than two windows behind it."""
    found = []
    for at in range(0, len(text), block):
        low = max(0, at - LONG.window + 1)
        _, place, hashes = _windows([text[low : at + block + 2 * LONG.window - 2]], LONG)
        found.append(hashes[(place >= at - low) & (place < at - low + block)])
    return np.concatenate(found)


def _features(texts: list[bytes], block: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of each feature, in order of text, scale and position. A text above ``block`` bytes is read in blocks."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    found = [(np.empty(0, np.int64), np.empty(0, np.uint64))]
    for scale in (TINY, SHORT, LONG):
        mine = np.array([i for i, t in enumerate(texts) if scale.takes(len(t)) and len(t) <= block], np.int64)
        if len(mine):
            which, _, hashes = _windows([texts[i] for i in mine], scale)
            found.append((mine[which], hashes))
    for i in np.flatnonzero(sizes > block):
        hashes = _block_windows(texts[i], block)
        found.append((np.full(len(hashes), i), hashes))
    whose, mixed = (np.concatenate(x) for x in zip(*found, strict=True))
    bare = np.flatnonzero((np.bincount(whose, minlength=len(texts)) == 0) & (sizes > 0))
    alone = [int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little") for i in bare]
    whose, mixed = np.concatenate([whose, bare]), np.concatenate([mixed, np.array(alone, np.uint64)])
    # a feature counts once in a text
    order = np.lexsort((np.arange(len(mixed)), mixed, whose))
    again = np.zeros(len(mixed), bool)
    again[order[1:]] = (whose[order[1:]] == whose[order[:-1]]) & (mixed[order[1:]] == mixed[order[:-1]])
    whose, mixed = whose[~again], mixed[~again]
    by_text = np.argsort(whose, kind="stable")
    return whose[by_text], mixed[by_text]


class Chain:
    """A fingerprint: its filters (rows of 256 bytes) and the features in each."""

    __slots__ = ("bits", "counts")

    def __init__(self, bits: np.ndarray, counts: np.ndarray):
        self.bits, self.counts = bits, counts

    def __str__(self) -> str:
        return "-".join(row.tobytes().hex() for row in self.bits)

    def likeness(self, other: Chain) -> float:
        if not len(self.counts) or not len(other.counts):
            return float(len(self.counts) == len(other.counts))
        few, many = sorted((self, other), key=lambda c: int(c.counts.sum()))
        theirs = many.bits.view(np.uint64)
        ones = np.bitwise_count(theirs).sum(axis=1, dtype=np.int64)
        total = 0.0
        for row, count in zip(few.bits.view(np.uint64), few.counts, strict=True):
            own = int(np.bitwise_count(row).sum(dtype=np.int64))
            common = np.bitwise_count(theirs & row).sum(axis=1, dtype=np.int64)
            chance = own * ones / FILTER_BITS
            total += count * float(np.max((common - chance) / np.maximum(own - chance, 1e-9)))
        return float(min(1.0, max(0.0, total / int(few.counts.sum()))))


def chains(texts: list[bytes]) -> list[Chain]:
    """Fingerprints of texts given as UTF-8."""
    whose, hashes = _features(texts)
    per_text = np.bincount(whose, minlength=len(texts))
    nth = np.arange(len(whose)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    filters = -(-per_text // FILTER_FEATURES)
    first = np.cumsum(filters) - filters
    filter_of = first[whose] + nth // FILTER_FEATURES
    out = []
    for at in range(0, len(texts), 256):  # bits unpacked for so many texts at a time
        upto = min(at + 256, len(texts))
        low, high = int(first[at]), int(first[upto - 1] + filters[upto - 1])
        mine = slice(int(np.searchsorted(whose, at)), int(np.searchsorted(whose, upto)))
        flags = np.zeros((high - low, FILTER_BITS), bool)
        rows = filter_of[mine] - low
        for k in range(FILTER_HASHES):
            flags[rows, ((hashes[mine] >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(flags, axis=1)
        counts = np.bincount(rows, minlength=high - low)
        out += [
            Chain(packed[first[i] - low : first[i] - low + filters[i]], counts[first[i] - low : first[i] - low + filters[i]])
            for i in range(at, upto)
        ]
    return out


def fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """The documents with the fingerprint of each text."""

    def run(batches):
        for batch in pieces(batches, text_col):
            texts = [t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            yield with_columns(batch, **{out: pa.array([str(c) for c in chains(texts)], pa.string())})

    return docs.mapInArrow(run, schema_with(docs, **{out: "string"}))


def edited(text: str, following: str) -> str:
    """The text, its last half (rounded down) replaced by as many first code points of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[str], own: list[Chain], following: list[tuple[str, Chain]]) -> pa.RecordBatch:
    changed = [edited(t, n).encode() for t, (n, _) in zip(texts, following, strict=True)]
    theirs = chains(changed)
    columns = {
        "id": ids,
        "n_chars": pa.array(map(len, texts), pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
        "fingerprint": pa.array(map(str, own), pa.string()),
        "edited_fingerprint": pa.array(map(str, theirs), pa.string()),
        "near_edited": pa.array([a.likeness(b) for a, b in zip(own, theirs, strict=True)], pa.float64()),
        "near_next": pa.array([a.likeness(b) for a, (_, b) in zip(own, following, strict=True)], pa.float64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def compare_along(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in descending order of id (nulls last; rows of one id, or of none, by a hash of the text and then the text), each compared
    with its edit by the next one and with the next one itself; the first follows the last. Returns id and the columns above.

    Texts are shuffled once, by ranges of id and hash, in which rows that are equal are told apart by their place, so that neither rows
    without id nor copies of one row end in one task; ranges are read as streams. Where one task's documents end and the next one's
    begin, the two documents meet in a second, small step: two rows per task.
    """
    kind = dict(docs.dtypes)[id_col]
    empty = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def along(batches):
        task = TaskContext.get().partitionId()
        held = first = None  # the last document so far, whose next one is still to come
        for batch in pieces(batches, "text"):
            ids, texts = batch.column("id"), [t or "" for t in batch.column("text").to_pylist()]
            own = chains([t.encode() for t in texts])
            first = first or (ids.slice(0, 1), texts[0])
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                texts, own = [held[1], *texts], [held[2], *own]
            if len(texts) > 1:
                done = _compared(ids.slice(0, len(texts) - 1), texts[:-1], own[:-1], list(zip(texts[1:], own[1:], strict=True)))
                nothing = len(done)
                yield with_columns(
                    done, text=pa.nulls(nothing, pa.string()), task=pa.array([task] * nothing, pa.int32()), edge=pa.nulls(nothing, pa.string())
                )
            held = ids.slice(len(texts) - 1, 1), texts[-1], own[-1]
        if held is not None:
            for (own_id, text), edge in ((first, "first"), (held[:2], "last")):
                blank = {name: pa.nulls(1, k) for name, k in empty.items()}
                yield pa.RecordBatch.from_arrays(
                    [own_id, *blank.values(), pa.array([text], pa.string()), pa.array([task], pa.int32()), pa.array([edge], pa.string())],
                    ["id", *blank, "text", "task", "edge"],
                )

    def across(batches):
        for batch in pieces(batches, "text"):
            texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            own, theirs = chains([t.encode() for t in texts]), chains([t.encode() for t in following])
            yield _compared(batch.column("id"), texts, own, list(zip(following, theirs, strict=True)))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("hash", F.xxhash64("text"))
    order = [F.desc_nulls_last("id"), F.desc("hash")]
    found = (
        rows.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(*order, "place")
        .sortWithinPartitions(*order, F.desc_nulls_last("text"))
        .select("id", "text")
        .mapInArrow(along, f"id {kind}, {_COLUMNS}, text string, task int, edge string")
    )
    found = materialise(found, "compared")
    edges = found.where("edge IS NOT NULL")
    first = edges.where("edge = 'first'")
    # numbers of tasks alone pass through one task; texts follow by a join
    before = F.lag("task").over(Window.orderBy("task"))
    tasks = first.select("task").select("task", F.coalesce(before, F.max("task").over(Window.partitionBy())).alias("before"))
    following = first.select("task", F.col("text").alias("following")).join(tasks, "task").select(F.col("before").alias("task"), "following")
    ends = edges.where("edge = 'last'").select("id", "text", "task").join(following, "task").select("id", "text", "following")
    names = [x.split()[0] for x in _COLUMNS.split(", ")]
    return found.where("edge IS NULL").select("id", *names).unionByName(ends.mapInArrow(across, f"id {kind}, {_COLUMNS}"))
