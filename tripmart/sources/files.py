"""File-level checks of a landing folder.

Names, sizes and times come from a listing that tasks make (``listing.walk``): no list of names is on the driver, and files of zero
bytes are part of it. Contents are read where the data is, in ranges or in steps, so a file may be of any size.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import math
import re
from codecs import getincrementaldecoder
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.sources.encodings import detect_encodings, likelihoods
from tripmart.sources.listing import STEP, matches, pieces_of, ranges, read_ranges, spread, walk
from tripmart.workspace import materialise

#: Bytes of a block in a file's tree of digests, and children of a node.
TREE_BLOCK, TREE_FAN = 16 << 20, 256
#: Bytes of a range of a text file.
TEXT_RANGE = 16 << 20
_BREAK = re.compile(rb"[\r\n]")
#: What reads a packed file, by its extension.
_UNPACK = {"gz": lambda file: gzip.GzipFile(fileobj=file), "bz2": bz2.BZ2File, "zst": lambda file: pa.CompressedInputStream(file, "zstd")}


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, length, modified_at`` of every file whose name fits the pattern, paths with their scheme; contents are not
    read."""
    files = walk(spark, path)
    return files.where(matches(F.col("path"), pattern)) if pattern else files


def file_gate(
    listing: DataFrame,
    extensions: tuple[str, ...] = S.ALLOWED_EXTENSIONS,
    min_bytes: int = S.MIN_FILE_BYTES,
) -> DataFrame:
    """Per file: is the extension allowed, is it large enough, and both."""
    extension = F.lower(F.regexp_extract(F.substring_index("path", "/", -1), r"\.([^./]+)$", 1))
    return listing.select(
        "path",
        extension.alias("extension"),
        "length",
        extension.isin(*extensions).alias("extension_ok"),
        (F.col("length") >= F.lit(min_bytes)).alias("size_ok"),
    ).withColumn("passed", F.col("extension_ok") & F.col("size_ok"))


def _md5(file, row) -> str:
    digest = hashlib.md5()
    for piece in pieces_of(file, 0, row["length"]):
        digest.update(piece)
    return digest.hexdigest()


def file_md5(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, length, md5`` of every file, streamed by one task each: MD5 cannot be shared out. For very large files
    see ``file_tree_digest``."""
    files = list_files(spark, path, pattern).select("path", "length")
    return read_ranges(spread(files, files), _md5, "md5", "string")


def _leaf(block: int):
    def run(file, row) -> bytes:
        start = row["number"] * block
        digest = hashlib.sha256()
        for piece in pieces_of(file, start, min(start + block, row["length"])):
            digest.update(piece)
        return digest.digest()

    return run


def file_tree_digest(
    spark: SparkSession, path: str, pattern: str | None = None, block: int = TREE_BLOCK, fan: int = TREE_FAN
) -> DataFrame:
    """``path, length, blocks, tree_digest``: a SHA-256 tree of every file, whatever its size.

    Leaves are the digests of fixed blocks, each hashed where it is read, so the blocks of one file go to many tasks. A node is the
    digest of the digests of up to ``fan`` neighbours, level by level, until one is left; a file of one block has that
    block's digest. Equal contents have equal trees for the same ``block`` and ``fan``.
    """
    files = list_files(spark, path, pattern).select("path", "length")
    rows = ranges(files, block)
    level = materialise(read_ranges(spread(files, rows), _leaf(block), "digest", "binary"), "file-blocks")
    most = level.agg(F.max("ranges")).first()[0] or 1
    level = level.select("path", "length", "ranges", F.col("ranges").alias("nodes"), "number", "digest")
    for _ in range(math.ceil(round(math.log(most, fan), 9)) if most > 1 else 0):
        children = F.array_sort(F.collect_list(F.struct("number", "digest")))  # ``fan`` at most
        joined = F.aggregate("children", F.lit(b""), lambda whole, child: F.concat(whole, child["digest"]))
        level = (
            level.groupBy("path", "length", "ranges", "nodes", F.floor(F.col("number") / fan).alias("parent"))
            .agg(children.alias("children"))
            .select(
                "path",
                "length",
                "ranges",
                F.ceil(F.col("nodes") / fan).cast("bigint").alias("nodes"),
                F.col("parent").alias("number"),
                F.when(F.col("nodes") == 1, F.col("children")[0]["digest"]).otherwise(F.unhex(F.sha2(joined, 256))).alias("digest"),
            )
        )
    return level.select("path", "length", F.col("ranges").alias("blocks"), F.lower(F.hex("digest")).alias("tree_digest"))


def file_encoding(
    spark: SparkSession, path: str, pattern: str | None = None, pairs: DataFrame | None = None
) -> DataFrame:
    """``path, length, encoding, confidence`` of whole files; ``pairs`` are learned pairs of characters
    (``encodings.learn_pairs``)."""
    return detect_encodings(list_files(spark, path, pattern).select("path", "length"), likelihoods(spark, pairs))


def _is_utf8(content: bytes) -> bool:
    try:
        content.decode()
    except UnicodeDecodeError:
        return False
    return True


def _lines_in(file, start: int, end: int, length: int) -> Iterator[bytes]:
    """The bytes of the lines that begin in a range of a file, some at a time; the last line may go on beyond it."""
    inside = start == 0
    for piece in pieces_of(file, max(start - 1, 0), end - 1):
        if not inside:
            found = _BREAK.search(piece)
            if not found:
                continue
            piece, inside = piece[found.end() :], True
        yield piece
    if inside:
        for piece in pieces_of(file, max(end - 1, 0), length):
            found = _BREAK.search(piece)
            yield piece[: found.start()] if found else piece
            if found:
                return


def _bad_lines(pieces: Iterable[bytes]) -> int:
    """How many lines are not UTF-8; a line may go over any number of pieces. Line feeds and carriage returns end lines."""
    decoder, broken, bad = getincrementaldecoder("utf-8")(), False, 0

    def is_broken(part: bytes, ends: bool) -> bool:
        try:
            decoder.decode(part, ends)
        except UnicodeDecodeError:
            return True
        return False

    for piece in pieces:
        piece = piece.replace(b"\r", b"\n")
        first, last = piece.find(b"\n"), piece.rfind(b"\n")
        if first < 0:
            broken = broken or is_broken(piece, False)
            continue
        bad += broken or is_broken(piece[:first], True)
        decoder.reset()
        whole = piece[first + 1 : last]
        bad += 0 if _is_utf8(whole) else sum(not _is_utf8(line) for line in whole.split(b"\n"))
        broken = is_broken(piece[last + 1 :], False)
    return bad + (broken or is_broken(b"", True))


def _bad_lines_of(size: int):
    def run(file, row) -> int:
        unpack = _UNPACK.get(row["path"].rpartition(".")[2])
        if unpack:
            with unpack(file) as content:
                return _bad_lines(iter(lambda: content.read(STEP), b""))
        start = row["number"] * size
        return _bad_lines(_lines_in(file, start, min(start + size, row["length"]), row["length"]))

    return run


def file_utf8(spark: SparkSession, path: str, pattern: str | None = "*.csv", size: int = TEXT_RANGE) -> DataFrame:
    """``path, length, bad_lines, is_utf8``: UTF-8 validity of whole text files, read in ranges of ``size`` bytes.

    A line break is never part of a multi-byte sequence, so a file is valid exactly if its lines are; large files are
    therefore split over tasks: a range has the lines that begin in it. Empty files are valid. Files ending in gz, bz2 and zst are
    unpacked by one task each.
    """
    files = list_files(spark, path, pattern).select("path", "length")
    packed = F.substring_index("path", ".", -1).isin(*_UNPACK)
    rows = ranges(files, F.when(packed, F.lit(1 << 62)).otherwise(F.lit(size)))
    read = read_ranges(spread(files, rows), _bad_lines_of(size), "bad", "bigint")
    return read.groupBy("path", "length").agg(F.sum("bad").alias("bad_lines")).withColumn("is_utf8", F.col("bad_lines") == 0)
