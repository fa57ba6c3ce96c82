"""The encoding of whole files, by name and with a confidence.

Files are read in ranges over all tasks. What a range says about an encoding is a set of counts that add up over the ranges of a
file, so the result does not depend on how files were cut:

* UTF-8: byte states, position by position: is a byte a continuation exactly where its predecessors ask for one? A range reads three
  bytes more on each side, and judges only its own positions.
* UTF-16 and UTF-32 in both byte orders: unpaired surrogates, values beyond Unicode, and zero bytes, which text in other encodings
  does not have. A byte order mark at the start of a file settles the matter.
* Single-byte encodings: how often each pair of neighbouring bytes with at least one above 127 occurs. Each encoding reads a pair as two
  characters, and a model says how likely these stand together: learned counts of character pairs, where there are any, on top of
  rules for letters, cases and scripts (``likelihoods``).

The model is a table of encodings times byte pairs, whatever the number of files, and is joined with the pair counts; the
best sum of logarithms names the encoding, and its share of the sum over all encodings is the confidence.
"""

from __future__ import annotations

import math
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.listing import ranges, read_ranges, spread
from tripmart.workspace import materialise

#: Single-byte encodings that are told apart: fixed names.
SINGLE_BYTE = ("windows-1252", "windows-1250", "windows-1251", "windows-1253", "koi8-r", "iso-8859-5", "cp850")
#: Byte order marks, longer ones first: fixed values.
MARKS = (
    ("utf-32-le", b"\xff\xfe\0\0"),
    ("utf-32-be", b"\0\0\xfe\xff"),
    ("utf-8", b"\xef\xbb\xbf"),
    ("utf-16-le", b"\xff\xfe"),
    ("utf-16-be", b"\xfe\xff"),
)
#: Bytes of a range; a multiple of four, so that no unit of UTF-16 or UTF-32 is cut.
RANGE = 16 << 20
#: Weight of the rules against learned counts, in pairs.
RULES_WEIGHT = 1000.0
_COUNTS = ("high", "zero", "bad8", "multi8", "bad16le", "bad16be", "bad32le", "bad32be", "zero_even", "zero_odd")
_STATE = "struct<mark: string, " + ", ".join(f"{c}: bigint" for c in _COUNTS) + ", pairs: array<struct<pair: int, n: bigint>>>"


# ------------------------------------------------------------------ counts of a range
def _bad_utf8(before: bytes, own: bytes, after: bytes) -> tuple[int, int]:
    """Own positions that UTF-8 does not allow, and own bytes that begin a longer character."""
    at_end = not after
    b = np.frombuffer(before + own + after + (b"\0\0\0" if at_end else b""), np.uint8)
    two, three, four = (b >= 0xC2) & (b <= 0xDF), (b >= 0xE0) & (b <= 0xEF), (b >= 0xF0) & (b <= 0xF4)
    asked = np.zeros(len(b), bool)
    asked[1:] |= (two | three | four)[:-1]
    asked[2:] |= (three | four)[:-2]
    asked[3:] |= four[:-3]
    bad = (asked != ((b & 0xC0) == 0x80)) | (b == 0xC0) | (b == 0xC1) | (b >= 0xF5)
    first, second = b[:-1], b[1:]
    narrow = ((first == 0xE0) & (second < 0xA0)) | ((first == 0xED) & (second > 0x9F)) | ((first == 0xF0) & (second < 0x90))
    bad[1:] |= (narrow | ((first == 0xF4) & (second > 0x8F))) & asked[1:]
    mine = slice(len(before), len(before) + len(own) + (3 if at_end else 0))
    return int(bad[mine].sum()), int((two | three | four)[len(before) : len(before) + len(own)].sum())


def _bad_units(before: bytes, own: bytes, after: bytes) -> dict[str, int]:
    """Unpaired surrogates and impossible values, unit by unit; bytes left over at the end of a file are one."""
    out = {}
    for name, kind in (("16le", "<u2"), ("16be", ">u2")):
        front = before[-2:] if len(before) > 1 else b""
        whole = front + own + after[:2]
        units = np.frombuffer(whole[: len(whole) // 2 * 2], kind)
        high, low = (units & 0xFC00) == 0xD800, (units & 0xFC00) == 0xDC00
        alone = (high & ~np.append(low[1:], False)) | (low & ~np.insert(high[:-1], 0, False)) if len(units) else high
        first = len(front) // 2
        out[f"bad{name}"] = int(alone[first : first + len(own) // 2].sum()) + len(own) % 2
    for name, kind in (("32le", "<u4"), ("32be", ">u4")):
        units = np.frombuffer(own[: len(own) // 4 * 4], kind)
        out[f"bad{name}"] = int(((units > 0x10FFFF) | ((units >= 0xD800) & (units < 0xE000))).sum()) + (len(own) % 4 > 0)
    return out


def _state(size: int):
    def run(file, row) -> dict:
        start = row["number"] * size
        end = min(start + size, row["length"])
        file.seek(max(0, start - 3))
        before = file.read(start - max(0, start - 3))
        own, after = file.read(end - start), file.read(4)
        b = np.frombuffer(own, np.uint8)
        bad8, multi8 = _bad_utf8(before, own, after[:3])
        pairs = np.frombuffer(own + after[:1], np.uint8).astype(np.int32)
        pairs = pairs[:-1] * 256 + pairs[1:]
        counts = np.bincount(pairs[((pairs & 0x8080) > 0)], minlength=0)
        found = np.flatnonzero(counts)
        mark = next((name for name, m in MARKS if own.startswith(m)), None) if not start else None
        return {
            "mark": mark,
            "high": int((b > 127).sum()),
            "zero": int((b == 0).sum()),
            "bad8": bad8,
            "multi8": multi8,
            **_bad_units(before, own, after),
            "zero_even": int((b[::2] == 0).sum()),
            "zero_odd": int((b[1::2] == 0).sum()),
            "pairs": [{"pair": p, "n": n} for p, n in zip(found.tolist(), counts[found].tolist(), strict=True)],
        }

    return run


# ------------------------------------------------------------------ the model
@cache
def _kind(c: str | None) -> tuple[str, str]:
    """Script or class of a character, and its case."""
    if c is None:
        return "none", ""
    category = unicodedata.category(c)
    if category[0] == "L":
        code = ord(c)
        script = "latin" if code < 0x250 else "greek" if code < 0x400 else "cyrillic" if code < 0x530 else "other"
        return script, "upper" if category == "Lu" else "lower"
    if category == "Cc" and c not in "\t\r\n":
        return "none", ""
    return ("space", "") if category in ("Zs", "Cc") else ("digit", "") if category[0] == "N" else ("mark", "")


def _usual(c: str) -> float:
    """Letters at the heart of a script against its additions."""
    code = ord(c)
    return 1.0 if code < 0x100 or 0x391 <= code <= 0x3CE or 0x410 <= code <= 0x44F else 0.2


def rule(a: str | None, b: str | None) -> float:
    """How likely two characters stand together, by rule: letters of one script in a usual order of cases are likely, marks
    and digits within words less, a capital after a small letter or another script hardly, control characters least."""
    (ka, case_a), (kb, case_b) = _kind(a), _kind(b)
    if "none" in (ka, kb):
        return 1e-10
    letters = ("latin", "greek", "cyrillic", "other")
    if ka in letters and kb in letters:
        order = {("lower", "lower"): 1e-4, ("upper", "lower"): 3e-5, ("upper", "upper"): 1e-5, ("lower", "upper"): 1e-8}[case_a, case_b]
        # Latin text is mostly ASCII: two letters beyond it side by side are rare
        rare = 0.02 if ka == kb == "latin" and min(a, b) > "\x7f" else 1.0
        return order * _usual(a) * _usual(b) * rare * (1.0 if ka == kb else 1e-4)
    if ka in letters or kb in letters:
        letter, other = (a, kb) if ka in letters else (b, ka)
        return {"space": 5e-5, "mark": 1e-6, "digit": 1e-7}[other] * _usual(letter)
    return 1e-6


def learn_pairs(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``a, b, n``: pairs of neighbouring characters with at least one beyond ASCII, over whole texts; copies count once."""
    different = texts.select(F.lower(text_col).alias("text")).where(F.col("text").rlike("[^\\x00-\\x7F]")).distinct()
    pair = F.explode(F.regexp_extract_all("text", F.lit("(?s)(?=([^\\x00-\\x7F].|.[^\\x00-\\x7F]))"), F.lit(1))).alias("pair")
    counted = different.select(pair).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.substring("pair", 1, 1).alias("a"), F.substring("pair", 2, 1).alias("b"), "n")


def _decoded(encoding: str) -> list[str | None]:
    out = []
    for b in range(256):
        c = bytes([b]).decode(encoding, "replace")
        out.append(None if c == "�" else c)
    return out


def likelihoods(spark: SparkSession, learned: DataFrame | None = None) -> DataFrame:
    """``encoding, pair, weight``: the logarithm of each byte pair's likelihood under each encoding. Of learned pairs only those of
    characters that some encoding has are asked for, so what passes the driver is bounded by the encodings."""
    tables = {e: _decoded(e) for e in SINGLE_BYTE}
    known = sorted({c for t in tables.values() for c in t if c})
    counts, total = {}, 0.0
    if learned is not None:
        inside = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in known) + "]"
        for row in learned.where(F.col("a").rlike(inside) & F.col("b").rlike(inside)).collect():
            counts[row.a, row.b] = row.n
            total += row.n
    rows = []
    for encoding, table in tables.items():
        for pair in range(1 << 16):
            if pair & 0x8080:
                a, b = table[pair >> 8], table[pair & 255]
                # learned in small letters, which a capital may begin
                seen = counts.get((a.lower(), b.lower()), 0) if a and b and _kind(b)[1] != "upper" else 0
                weight = (seen + RULES_WEIGHT * rule(a, b)) / (total + RULES_WEIGHT)
                rows.append((encoding, pair, math.log(weight)))
    names = ["encoding", "pair", "weight"]
    table = pa.table([pa.array(c) for c in zip(*rows, strict=True)], names)
    return spark.createDataFrame(table.set_column(1, "pair", table["pair"].cast(pa.int32())))


# ------------------------------------------------------------------ verdicts
def detect_encodings(files: DataFrame, model: DataFrame, size: int = RANGE) -> DataFrame:
    """``path, length, encoding, confidence`` of files (path, length). An empty file is ``ascii``; a file that no encoding
    explains is named by the least unlikely one, with its confidence."""
    if size % 4:
        raise ValueError("ranges must be multiples of four bytes")
    read = materialise(read_ranges(spread(files, ranges(files, size)), _state(size), "state", _STATE), "encoding-counts")
    per_file = read.groupBy("path", "length").agg(
        F.max("state.mark").alias("mark"), *[F.sum(f"state.{c}").alias(c) for c in _COUNTS]
    )
    pairs = (
        read.select("path", F.explode("state.pairs").alias("of"))
        .groupBy("path", F.col("of.pair").alias("pair"))
        .agg(F.sum("of.n").alias("n"))
    )
    # a row per encoding and byte pair, whatever the files
    sums = pairs.join(F.broadcast(model), "pair").groupBy("path", "encoding").agg(F.sum(F.col("n") * F.col("weight")).alias("sum"))
    best = sums.groupBy("path").agg(
        F.max(F.struct("sum", "encoding")).alias("best"), F.collect_list("sum").alias("sums")
    )
    by_pairs = best.select(
        F.col("path"),
        F.col("best.encoding").alias("by_pairs"),
        (1 / F.aggregate("sums", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("best.sum")))).alias("share"),
    )
    wide = (
        F.when(F.col("zero") == 0, None)
        .when((F.col("bad32le") == 0) & (F.col("zero") * 2 >= F.col("length")), "utf-32-le")
        .when((F.col("bad32be") == 0) & (F.col("zero") * 2 >= F.col("length")), "utf-32-be")
        .when((F.col("bad16le") == 0) & (F.col("zero_odd") > F.col("zero_even")), "utf-16-le")
        .when((F.col("bad16be") == 0) & (F.col("zero_even") > F.col("zero_odd")), "utf-16-be")
    )
    most = F.greatest("zero_odd", "zero_even")
    by_unit, text, is_ascii = F.col("wide").isNotNull(), F.col("bad8") == 0, F.col("high") == 0
    name = (
        F.when(F.col("mark").isNotNull(), F.col("mark"))
        .when(by_unit, F.col("wide"))
        .when(text & is_ascii, "ascii")
        .when(text, "utf-8")
        .otherwise(F.col("by_pairs"))
    )
    sure = (
        F.when(F.col("mark").isNotNull(), 1.0)
        .when(by_unit, F.least(F.lit(1.0), 0.5 + most / F.col("length")))
        .when(text & is_ascii, 1.0)
        .when(text, 1 - F.pow(F.lit(0.5), F.col("multi8").cast("double")))
        .otherwise(F.col("share"))
    )
    return (
        per_file.join(by_pairs, "path", "left")
        .withColumn("wide", wide)
        .select("path", "length", name.alias("encoding"), sure.alias("confidence"))
    )
