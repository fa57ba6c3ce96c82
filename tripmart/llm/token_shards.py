"""Token ids in binary shards that give access to single short documents.

Format. A dataset is a folder with ``dictionary/`` (one file: a zstandard dictionary) and ``shards/``. A shard holds
documents in ascending id order, each compressed by itself with the shared dictionary::

    frame NUL frame NUL ... index NUL trailer NUL

* frame: a zstandard frame of the document's ids, little-endian unsigned integers of ``width`` bytes
* index: a zstandard frame of 40-byte entries: id (int64), flag 1 for a null id, tokens before it in the shard, number of
  tokens, offset of its frame
* trailer, 80 bytes: magic, shard number, width, documents, tokens, offset of the index, SHA-256 of the dictionary

The NUL after each part is the record separator of Spark's text writer, which writes the files: so a lost task is written
again and only whole shards appear. Readers open a shard from its end and refuse another dictionary. The dictionary is
trained on the serialized ids of about SAMPLE_DOCUMENTS documents, chosen by a hash; it changes sizes, not contents.

Texts are not shuffled. Compressed documents are, once, by ranges of id. A null text has no ids but what ``end_id`` adds. Null
ids come first; rows of one id lie next to each other, ordered by a hash of their bytes. Extra columns are ignored. An empty table
gives a dataset without shards, which reads as an empty table.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.bpe import _vocabulary
from tripmart.llm.common import pieces
from tripmart.llm.word_bpe import Speller, by_library
from tripmart.workspace import materialise

MAGIC = b"TMTOK001"
TRAILER = "<8s5q32s"
TRAILER_BYTES = struct.calcsize(TRAILER)
ENTRY = np.dtype([("id", "<i8"), ("null", "<i8"), ("start", "<i8"), ("tokens", "<i8"), ("offset", "<i8")])
SAMPLE_DOCUMENTS = 2_000
DICTIONARY_BYTES = 1 << 16
SHARD_BYTES = 16 << 20
#: Rows of two numbers that may be broadcast, one per shard: 3 MB at most.
BROADCAST_SHARDS = 200_000
SHARD_GROUP = 1_000
LEVEL = 3


@lru_cache(maxsize=1)
def _speller(content: bytes) -> Speller:
    """One for all tasks of a worker: frequent words are spelled once."""
    vocabulary = _vocabulary(content)
    return Speller(vocabulary, by_library(vocabulary))


def _serialized(content: bytes, text_col: str, end_id: int | None, width: int, id_col: str, pack):
    """A task: texts to (id, tokens, frame), the frame made by ``pack`` from the serialized ids."""

    def run(batches):
        speller, make = _speller(content), pack()
        tail = b"" if end_id is None else end_id.to_bytes(width, "little")
        for batch in pieces(batches, text_col):
            ids = speller.spell(batch.column(text_col).to_pylist())
            flat, bounds = ids.values.to_numpy().astype(f"<u{width}"), ids.offsets.to_numpy()
            raw, bounds = flat.tobytes(), (bounds * width).tolist()
            whole = [raw[a:b] + tail for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).cast(pa.int64()),
                    pa.array([len(x) // width for x in whole], pa.int64()),
                    pa.array([make(x) for x in whole], pa.binary()),
                ],
                ["id", "tokens", "frame"],
            )

    return run


def train_dictionary(docs, content, id_col="doc_id", text_col="text", end_id=None, width=2, sample=SAMPLE_DOCUMENTS, size=DICTIONARY_BYTES) -> bytes:
    """From about ``sample`` documents, chosen by a hash of id and text; of each the first 32 KB count. Too few or too small
    ones give no dictionary, which is also a valid one."""
    import zstandard

    step = 1 << 40
    part = min(step, -(-sample * step // max(1, docs.select(id_col).count())))
    chosen = docs.select(id_col, text_col).where(F.pmod(F.xxhash64(id_col, text_col), F.lit(step)) < part)
    rows = chosen.mapInArrow(
        _serialized(content, text_col, end_id, width, id_col, lambda: lambda raw: raw[: 1 << 15]),
        "id bigint, tokens bigint, frame binary",
    ).collect()
    samples = [bytes(r.frame) for r in rows if r.frame]
    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def _write_rows(rows: DataFrame, path: str) -> None:
    """Rows of one binary column as the parts of files, each followed by NUL; a file per task."""
    column = rows.columns[0]
    rows.select(F.col(column).cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", 0
    ).mode("overwrite").text(path)


def write_shards(
    docs: DataFrame,
    path: str,
    content: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode, compress and write every document below ``path``."""
    import zstandard

    spark = docs.sparkSession
    vocabulary = _vocabulary(content)
    width = 2 if max(len(vocabulary.tokens) - 1, end_id or 0) < 1 << 16 else 4
    dictionary = train_dictionary(docs, content, id_col, text_col, end_id, width)
    _write_rows(spark.createDataFrame([(bytearray(dictionary),)], "part binary").coalesce(1), f"{path}/dictionary")
    digest = hashlib.sha256(dictionary).digest()

    def packer():
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True, write_dict_id=False).compress

    frames = materialise(
        docs.select(id_col, text_col).mapInArrow(
            _serialized(content, text_col, end_id, width, id_col, packer), "id bigint, tokens bigint, frame binary"
        ),
        "frames",
    )
    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0

    def shards(batches):
        offset = start = 0
        index = []
        for batch in batches:
            ids, parts = batch.column("id").to_pylist(), batch.column("frame").to_pylist()
            entries = np.zeros(len(ids), ENTRY)
            entries["id"] = [i or 0 for i in ids]
            entries["null"] = [i is None for i in ids]
            entries["tokens"] = batch.column("tokens").to_numpy()
            ends = np.cumsum(entries["tokens"])
            entries["start"] = start + ends - entries["tokens"]
            sizes = np.cumsum([len(p) + 1 for p in parts])
            entries["offset"] = offset + sizes - [len(p) + 1 for p in parts]
            if len(ids):
                start, offset = start + int(ends[-1]), offset + int(sizes[-1])
                index.append(entries)
            yield pa.RecordBatch.from_arrays([batch.column("frame")], ["part"])
        if index:
            table = np.concatenate(index)
            number = TaskContext.get().partitionId()
            trailer = struct.pack(TRAILER, MAGIC, number, width, len(table), start, offset, digest)
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(table.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([packed, trailer], pa.binary())], ["part"])

    # rows without id, and copies of one row, are spread over shards by a hash and their place
    order = [F.asc_nulls_first("id"), F.asc("hash")]
    ordered = (
        frames.withColumns({"hash": F.xxhash64("frame"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(max(1, -(-total // shard_bytes)), *order, "place")
        .sortWithinPartitions(*order, "frame")
        .select("id", "tokens", "frame")
    )
    _write_rows(ordered.mapInArrow(shards, "part binary"), f"{path}/shards")


@lru_cache(maxsize=1)
def _unpacker(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=known).decompress


def open_shard(shard: bytes | memoryview, dictionary: bytes) -> tuple[int, int, np.ndarray]:
    """Shard number, width of an id and index of a shard file's bytes."""
    import zstandard

    magic, number, width, documents, _, at, digest = struct.unpack(TRAILER, shard[-TRAILER_BYTES - 1 : -1])
    if magic != MAGIC:
        raise ValueError("not a shard")
    if digest != hashlib.sha256(dictionary).digest():
        raise ValueError("the shard was written with another dictionary")
    index = np.frombuffer(zstandard.ZstdDecompressor().decompress(shard[at : -TRAILER_BYTES - 2]), ENTRY)
    if len(index) != documents:
        raise ValueError("the index does not fit the shard")
    return number, width, index


def read_document(shard: bytes | memoryview, index: np.ndarray, width: int, dictionary: bytes, row: int) -> np.ndarray:
    """The ids of the row-th document of a shard; only its frame is touched."""
    begin = int(index["offset"][row])
    end = int(index["offset"][row + 1]) - 1 if row + 1 < len(index) else struct.unpack(TRAILER, shard[-TRAILER_BYTES - 1 : -1])[5] - 1
    return np.frombuffer(_unpacker(dictionary)(shard[begin:end]), f"<u{width}")


def read_shards(spark: SparkSession, path: str, as_bytes: bool = False, broadcast_shards: int = BROADCAST_SHARDS) -> DataFrame:
    """Every document of a dataset: id, start (ids of all documents before it), n_tokens, ids. ``as_bytes`` gives the ids
    as little-endian unsigned 32-bit integers in a binary value instead of an array. Documents meet the start of their shard
    by a broadcast of at most ``broadcast_shards`` rows, beyond that by a sort-merge join."""
    files = spark.read.format("binaryFile").load(f"{path}/shards").where("length > 0").select("content")
    head = spark.read.format("binaryFile").load(f"{path}/dictionary").where("length > 0").select("content").first()
    dictionary = bytes(head.content)[:-1] if head else b""

    def run(batches):
        kind = pa.binary() if as_bytes else pa.list_(pa.int32())
        for batch in batches:
            for content in batch.column("content"):
                shard = memoryview(content.as_buffer())
                number, width, index = open_shard(shard, dictionary)
                for at in range(0, len(index), 512):
                    rows = range(at, min(at + 512, len(index)))
                    ids = [read_document(shard, index, width, dictionary, i).astype("<u4") for i in rows]
                    part = index[at : at + 512]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number] * len(part), pa.int64()),
                            pa.array(part["id"], mask=part["null"] == 1),
                            pa.array(part["start"]),
                            pa.array(part["tokens"]),
                            pa.array([x.tobytes() for x in ids] if as_bytes else [x.astype("<i4") for x in ids], kind),
                        ],
                        ["shard", "id", "start", "n_tokens", "ids"],
                    )

    kind = "binary" if as_bytes else "array<int>"
    rows = files.mapInArrow(run, f"shard bigint, id bigint, start bigint, n_tokens bigint, ids {kind}")
    bases = materialise(shard_bases(spark, path), "shard-bases")
    few = bases.count() <= broadcast_shards
    return rows.join(F.broadcast(bases) if few else bases.hint("merge"), "shard").select(
        "id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids"
    )


def shard_bases(spark: SparkSession, path: str, group: int = SHARD_GROUP) -> DataFrame:
    """The number of ids in all shards before each one; a row per shard. Shards are added up in groups of so many first, and only
    one row per group passes through one task."""
    files = spark.read.format("binaryFile").load(f"{path}/shards").where("length > 0").select("content")

    def run(batches):
        for batch in batches:
            found = [struct.unpack(TRAILER, memoryview(c.as_buffer())[-TRAILER_BYTES - 1 : -1]) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[1] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                ["shard", "tokens"],
            )

    sizes = materialise(files.mapInArrow(run, "shard bigint, tokens bigint"), "shard-sizes").withColumn(
        "group", F.floor(F.col("shard") / group)
    )
    upto = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("group").agg(F.sum("tokens").alias("whole")).select(
        "group", F.coalesce(F.sum("whole").over(upto), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(groups, "group").select(
        "shard", (F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("base")
    )
