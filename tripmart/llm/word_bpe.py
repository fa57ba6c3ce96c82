"""Word-level byte-pair encoding as the public word vocabularies define it: what a text's words are, and what a word's ids.

A text is cut at literal special tokens; the rest is normalised (NFC, white space to one blank, lower case), words are found
by the file's pattern, and the bytes of a word are merged by rank, its last symbol carrying the word-end mark. Words are
independent of one another and never reach over white space, so a task resolves each distinct chunk between white space once
and spells texts with table look-ups.

Which characters are letters, digits and marks, and their lower case, depends on the version of Unicode a program knows. Chunks of
characters below ``PROVEN`` (a test compares each of them) are normalised and cut here; others are handed to the tokenizers library
as they are, which applies its own tables.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import cached_property
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import regex

#: Beyond so many chunks a task forgets all but the first KEPT it met, mostly frequent ones; results do not depend on it.
MEMO_WORDS, KEPT = 250_000, 170_000
#: Below this code point the library and the modules used here agree on every character.
PROVEN = 0x250
#: Words that the library spells in one call.
SPELLED = 1_000
#: What Python takes for white space but the pattern does not: texts with it are split by the pattern alone.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: White space of the file's pattern, spelled out for texts that have separators.
_SPACES = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_UNPROVEN = regex.compile(f"[^\0-{chr(PROVEN - 1)}]").search
#: A mark between a letter or digit and white space is a word of its own: cut off, words with and without it are one chunk.
_STOP = re.compile("(?<=[0-9a-z])([.,;:!?])(?=[\t-\r \x85\xa0]|$)")

Chunk = str | bytes | int


def _beyond(text: str) -> bool:
    """Are there characters beyond the proven ones? Most texts are answered by an encoder."""
    try:
        text.encode("latin-1")
        return False
    except UnicodeEncodeError:
        return _UNPROVEN(text) is not None


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: a byte that prints in Latin-1 is
    itself, the others follow from U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """A vocabulary file's content, for tokenizers of the kind named above; others are refused."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self.content = content
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
            and (byte_level["type"], byte_level["add_prefix_space"]) == ("ByteLevel", False)
            and model["type"] == "BPE"
            and not (model["dropout"] or model["continuing_subword_prefix"] or model["byte_fallback"] or model["ignore_merges"])
            and spec.get("decoder") is None
            and spec.get("post_processor") is None
        )
        if not known:
            raise ValueError("not a word-level BPE vocabulary of the supported kind")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(split["pattern"]["Regex"]).findall
        # white space becomes a blank in the file's own steps; no word has any, so the words are the same without
        if self.pattern("a \t\x85\u2003b") != ["a", "b"] or steps[1]["content"] != " ":
            raise ValueError("words with white space in them are not supported")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.bytes = byte_alphabet()
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: letters lower one by one
        return text.lower()

    def _plain(self, text: str) -> list[Chunk]:
        """Chunks of a text without special tokens."""
        cut = _SPACES.split if any(c in text for c in _SEPARATORS) else str.split
        if text.isascii() or not _beyond(text):
            return [c for c in cut(_STOP.sub(r" \1", self._normal(text))) if c]
        return [c.encode() if _beyond(c) else self._normal(c) for c in cut(text) if c]

    def chunks(self, text: str) -> list[Chunk]:
        """The text cut at white space: no word reaches over it, so ``words`` of each chunk in turn are the words of the text. A
        chunk comes in normal form; one with characters beyond the proven ones as it is, in bytes; a special token as its id."""
        if not any(token in text for token in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    @cached_property
    def library(self):
        """The file's tokenizer, without truncation and padding."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self.content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @cached_property
    def _byte_of(self) -> dict[str, int]:
        return {c: b for b, c in enumerate(self.bytes)}

    def words(self, chunk: str | bytes) -> list[str]:
        """The words of a chunk, in order."""
        if isinstance(chunk, str):
            return self.pattern(chunk)
        whole = self.library.normalizer.normalize_str(chunk.decode())
        return [bytes(map(self._byte_of.__getitem__, w)).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(whole)]

    @cached_property
    def ranks(self) -> dict[tuple[str, str], int]:
        pairs = (m if isinstance(m, list) else m.split(" ") for m in json.loads(self.content)["model"]["merges"])
        return {(a, b): rank for rank, (a, b) in enumerate(pairs)}

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the adjacent pair of lowest rank, the leftmost of equals, merges until none is left."""
        symbols = [self.bytes[b] for b in word.encode()]
        symbols[-1] += self.end
        rank, none = self.ranks.get, 1 << 60
        ranks = list(map(rank, zip(symbols, symbols[1:], strict=False), repeat(none)))
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i] += symbols.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
        return [self.ids[s] for s in symbols]


class _Codes(dict):
    """Numbers chunks as they are met."""

    def __missing__(self, chunk):
        self[chunk] = code = len(self)
        return code


#: Chunks to the ids of all of them, one after the other, and the number of ids of each.
Resolve = Callable[[list[str | bytes]], tuple[np.ndarray, np.ndarray]]


class Speller:
    """Turns texts into ids. ``resolve`` gives the ids of chunks not met before."""

    def __init__(self, vocabulary: Vocabulary, resolve: Resolve):
        self.vocabulary, self.resolve = vocabulary, resolve
        self.codes = _Codes()
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _forget(self) -> None:
        self.codes = _Codes(islice(self.codes.items(), KEPT))
        self.ends = self.ends[: KEPT + 1]
        self.flat = self.flat[: self.ends[-1]]

    def _learn(self, known: int) -> None:
        """The ids of the chunks numbered from ``known`` on."""
        fresh = list(islice(self.codes, known, None))
        special = [(i, c) for i, c in enumerate(fresh) if isinstance(c, int)]
        flat, lengths = self.resolve([c for c in fresh if not isinstance(c, int)] if special else fresh)
        for i, c in special:  # a handful in a vocabulary
            at = int(lengths[:i].sum())
            flat, lengths = np.insert(flat, at, c), np.insert(lengths, i, 1)
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def spell(self, texts: list[str | None]) -> pa.ListArray:
        """Ids of each text; null and empty have none."""
        if len(self.codes) > MEMO_WORDS:
            self._forget()
        split = [self.vocabulary.chunks(t) if t else [] for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        known = len(self.codes)
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if len(self.codes) > known:
            self._learn(known)
        lengths = self.ends[codes + 1] - self.ends[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self.ends[codes] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(self.flat[at], pa.int32()))


def _words_of(vocabulary: Vocabulary, chunks: list[str | bytes]) -> list[list[str]]:
    """The words of each chunk; a chunk of letters is one word, as long as they are proven ones."""
    return [[c] if isinstance(c, str) and c.isalpha() else vocabulary.words(c) for c in chunks]


def library_merges(vocabulary: Vocabulary) -> Resolve:
    """The ids of words, by the merges of the tokenizers library, many in one call: their bytes as the file writes them, one blank
    between words. A word's last id carries the word-end mark, which tells words apart; should the numbers differ (no mark), each
    word is merged by itself."""
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(vocabulary.library.model)
    bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    last = np.array([bool(vocabulary.end) and t.endswith(vocabulary.end) for t in vocabulary.tokens])
    plain = dict(enumerate(vocabulary.bytes))

    def spelled(word: str) -> str:
        # ASCII letters stand for themselves; other bytes have a character of their own
        return word if word.isalpha() and word.isascii() else word.encode().decode("latin-1").translate(plain)

    def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(words), SPELLED):
            some = words[at : at + SPELLED]
            found = np.array(bare.encode(" ".join(map(spelled, some)), add_special_tokens=False).ids, np.int64)
            ends = np.flatnonzero(last[found])
            if len(ends) == len(some):
                ids.append(found)
                lengths.append(np.diff(ends, prepend=-1))
            else:
                lists = list(map(vocabulary.merge, some))
                ids.append(np.fromiter(chain.from_iterable(lists), np.int64))
                lengths.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        return np.concatenate(ids), np.concatenate(lengths)

    return run


def by_words(vocabulary: Vocabulary, known: Callable[[list[str]], Iterable[list[int] | None]]) -> Resolve:
    """Chunks resolved by the ids of their distinct words: those that ``known`` tells, the others merged exactly."""
    merges = library_merges(vocabulary)

    def run(chunks: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts = _words_of(vocabulary, chunks)
        words = list({w for part in parts for w in part})
        ids = dict(zip(words, known(words), strict=True))
        unseen = [w for w, found in ids.items() if found is None]
        flat, lengths = merges(unseen)
        ends = np.cumsum(lengths).tolist()
        flat = flat.tolist()
        ids.update((w, flat[a:b]) for w, a, b in zip(unseen, [0, *ends], ends, strict=False))
        lists = [[i for w in part for i in ids[w]] for part in parts]
        return np.fromiter(chain.from_iterable(lists), np.int32), np.fromiter(map(len, lists), np.int64, len(lists))

    return run


def by_library(vocabulary: Vocabulary) -> Resolve:
    """Chunks resolved by the library's merges of their words."""
    merges = library_merges(vocabulary)

    def run(chunks: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts = _words_of(vocabulary, chunks)
        flat, lengths = merges([w for part in parts for w in part])
        before = np.concatenate(([0], np.cumsum(lengths)))
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))
        return flat, np.diff(before[bounds])

    return run
