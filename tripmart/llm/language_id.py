"""Language identification with a bit-sliced Bloom filter of letter n-grams.

Learning counts n-grams per language in a bounded sample of labelled texts and keeps those that make up at least MIN_RATE of
a language's n-grams (so 1 / MIN_RATE per language at most). One filter holds them all: each of its cells is a bit mask of
languages, and an n-gram's mask is the AND of its cells, so one look-up tells every language that has the n-gram. A text's
votes per language are the set bits counted over all its n-grams; since a cell's bit is also set by chance, the share of
votes is corrected by the language's false-positive rate, its share of set bits to the number of cells an n-gram has.

An n-gram is a run of letters of one word, with the word's border as a letter. Whole texts are read, long ones block by block.
Null texts, and texts without a letter, are ``und`` with score 0. A text whose n-grams are in no language gets the first
learned language with score 1 / languages. Repeated rows get equal results; an empty table an empty one. Extra columns stay,
new ones replace those of their name. Without a labelled text there is no language to tell: every text is ``und`` with score 0. The
masks take as many 64-bit words as the languages need.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import pieces, schema_with, with_columns
from tripmart.workspace import materialise

SIZES = (3, 4)
CELLS_LOG2 = 20
HASHES = 3
MIN_RATE = 2e-5
#: Labelled texts that learning reads per language, about.
SAMPLE_TEXTS = 3_000
UNKNOWN = "und"
#: Code points of a text above which it is read in blocks of so many.
BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case as one array of code points, a line feed before, between and after them; and where each begins and
    the last one ends."""
    lowered = [t.lower() if t else "" for t in texts]
    points = np.frombuffer(("\n" + "".join(t + "\n" for t in lowered)).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.concatenate(([0], np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)))


def _grams(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the n-grams of one size: letters inside, a letter or a border at either end."""
    letters = np.where(_letters()[points], points, 0).astype(np.uint64)
    span = len(letters) - size + 1
    if span <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = letters > 0
    valid = inside[1 : 1 + span].copy()
    for k in range(2, size - 1):
        valid &= inside[k : k + span]
    place = np.flatnonzero(valid)
    mixed = np.full(len(place), size, np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + letters[place + k]
    return place, _mix(mixed)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, text after text for each size; the bounds of each text's hashes in them (texts x sizes); and
    which texts have a letter."""
    points, edges = _points(texts)
    hashes, bounds, at = [], [], 0
    for size in SIZES:
        place, found = _grams(points, size)
        hashes.append(found)
        cuts = np.searchsorted(place, edges) + at
        bounds.append(np.stack([cuts[:-1], cuts[1:]], axis=1))
        at += len(place)
    seen = np.concatenate(([0], np.cumsum(_letters()[points])))
    return np.concatenate(hashes), np.stack(bounds, axis=1), seen[edges[1:]] > seen[edges[:-1]]


def ngram_blocks(text: str, block: int) -> Iterator[np.ndarray]:
    """The hashes of the n-grams of a long text, from so many places at a time."""
    points, _ = _points([text])
    for at in range(0, len(points), block):
        for size in SIZES:
            yield _grams(points[at : at + block + size - 1], size)[1]


@dataclass(frozen=True)
class LanguageFilter:
    languages: tuple[str, ...]
    cells: np.ndarray  # words of a mask x cells

    @classmethod
    def of(cls, grams: dict[str, np.ndarray]) -> LanguageFilter:
        """From the n-gram hashes of each language."""
        names = tuple(sorted(grams))
        kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(names) <= np.iinfo(k).bits), np.uint64)
        cells = np.zeros((-(-len(names) // np.iinfo(kind).bits), 1 << CELLS_LOG2), kind)
        for number, name in enumerate(names):
            word, bit = divmod(number, np.iinfo(kind).bits)
            for at in cls._cells(grams[name].astype(np.uint64)):
                cells[word][at] |= kind(1 << bit)
        return cls(names, cells)

    @staticmethod
    def _cells(hashes: np.ndarray) -> list[np.ndarray]:
        last = np.uint64((1 << CELLS_LOG2) - 1)
        return [((hashes >> np.uint64(20 * i)) & last).astype(np.int64) for i in range(HASHES)]

    def _bit(self, masks: np.ndarray, number: int) -> np.ndarray:
        """The bit of a language in masks (words x n)."""
        word, bit = divmod(number, np.iinfo(self.cells.dtype).bits)
        return (masks[word] >> np.asarray(bit, masks.dtype)) & masks.dtype.type(1)

    def false_rates(self) -> np.ndarray:
        return np.array([float(self._bit(self.cells, b).mean()) for b in range(len(self.languages))]) ** HASHES

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The languages that have each n-gram (words x n)."""
        first, *rest = self._cells(hashes)
        out = self.cells[:, first]
        for at in rest:
            out = out & self.cells[:, at]
        return out

    def _long_share(self, text: str, block: int) -> tuple[np.ndarray, int]:
        """Votes per language and the number of n-grams of a long text, read block by block."""
        votes, total = np.zeros(len(self.languages), np.int64), 0
        for hashes in ngram_blocks(text, block):
            masks = self.masks(hashes)
            votes += [int(self._bit(masks, bit).sum(dtype=np.int64)) for bit in range(len(self.languages))]
            total += len(hashes)
        return votes, total

    def shares(self, texts: list[str | None], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the corrected share of n-grams the language has; which texts have a letter."""
        long = [i for i, t in enumerate(texts) if t and len(t) > block]
        hashes, bounds, has_letter = ngrams([None if t and len(t) > block else t for t in texts])
        masks = self.masks(hashes)
        total = (bounds[:, :, 1] - bounds[:, :, 0]).sum(axis=1)
        votes = np.zeros((len(texts), len(self.languages)), np.int64)
        for bit in range(len(self.languages)):
            upto = np.concatenate(([0], np.cumsum(self._bit(masks, bit), dtype=np.int64)))
            votes[:, bit] = (upto[bounds[:, :, 1]] - upto[bounds[:, :, 0]]).sum(axis=1)
        for i in long:
            votes[i], total[i] = self._long_share(texts[i], block)
            has_letter[i] = total[i] > 0  # a letter makes an n-gram of three
        share = votes / np.maximum(total, 1)[:, None]
        wrong = self.false_rates()
        return np.maximum(0, (share - wrong) / np.maximum(1 - wrong, 1e-9)), has_letter


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_TEXTS) -> LanguageFilter:
    """From about ``sample`` different texts per language, chosen by a hash of the text; all if there are fewer."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    different = rows.select("lang", "hash").distinct()
    sizes = {r.lang: r.n for r in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    step = 1 << 20
    part = F.lit(0)
    for lang, n in sizes.items():
        part = F.when(F.col("lang") == lang, F.lit(min(step, -(-sample * step // n)))).otherwise(part)
    chosen = rows.where(F.pmod("hash", F.lit(step)) < part).dropDuplicates(["lang", "hash"]).select("text", "lang")

    def run(batches):
        for batch in pieces(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, its in zip(texts, langs, strict=True) if its == lang]
                short = ngrams([t for t in own if len(t) <= BLOCK])[0]
                for hashes in chain([short], *(ngram_blocks(t, BLOCK) for t in own if len(t) > BLOCK)):
                    grams, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts, pa.int64())],
                        ["lang", "gram", "n"],
                    )

    counted = chosen.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "gram-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    common = counted.join(F.broadcast(totals), "lang").where(F.col("n") >= F.greatest(F.lit(2), F.col("total") * MIN_RATE))
    found: dict[str, list[int]] = {lang: [] for lang in sizes}
    for row in common.groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect():
        found[row.lang] = row.grams
    return LanguageFilter.of({lang: np.array(g, np.int64).view(np.uint64) for lang, g in found.items()})


def identify(docs: DataFrame, model: LanguageFilter, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (how far the winner leads the next: 0.5 to 1) and ``lang_share`` (the share of
    n-grams the winner has); without the text unless ``keep_text``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.cells))  # 8 MB for each 64 languages

    def run(batches):
        languages, cells = shared.value
        known = LanguageFilter(languages, cells)
        for batch in pieces(batches, text_col):
            shares, has_letter = known.shares(batch.column(text_col).to_pylist())
            if not languages:
                shares, has_letter = np.zeros((len(shares), 1)), np.zeros(len(shares), bool)
            rows = np.arange(len(shares))
            best = shares.argmax(axis=1)
            top = shares[rows, best]
            rest = shares.copy()
            rest[rows, best] = 0
            score = np.where(top > 0, top / np.maximum(top + rest.max(axis=1), 1e-12), 1 / max(1, len(languages)))
            pred = [languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)]
            keep = [n for n in batch.schema.names if keep_text or n != text_col]
            yield with_columns(
                batch.select(keep),
                lang_pred=pa.array(pred, pa.string()),
                score=pa.array(np.where(has_letter, score, 0.0)),
                lang_share=pa.array(np.where(has_letter, top, 0.0)),
            )

    rest = docs if keep_text else docs.drop(text_col)
    schema = schema_with(rest, lang_pred="string", score="double", lang_share="double")
    return docs.mapInArrow(run, schema)
