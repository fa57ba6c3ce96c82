"""WARC archives: writing them as whole-file gzip streams, normalising those to one gzip member per record with a sidecar
offset index, and reading records back by offset.

* ``write_monolithic`` is what many crawlers leave: files that are one gzip stream each, which can only be read from the
  start. The records are built by SQL functions and compressed by Spark's own writer.
* ``normalise`` inflates each such stream once, in bounded memory, and writes every record as its own member
  (``kind=warc/archive=...``) with an index of gzip members of JSON lines beside it (``kind=index/archive=...``): record id,
  type, offset, length of the member.
* ``read_archives`` takes members by the index's offsets and inflates each alone.

Files are written by Spark's text writer, so a lost task leaves nothing and is done again. Its one-byte record separator,
NUL, is the last byte of the member before it: a member ends with the high byte of its size, which is 0 below 16 MiB; a
larger one is followed by an empty member, which ends so too. The files are plain concatenated gzip members.

Of pages with equal payloads (SHA-1 and length) of at least ``min_payload`` bytes, the one with the smallest id is a response,
others are revisits that name it. Up to BROADCAST_PAYLOADS repeated payloads are broadcast and no page is shuffled. Of more, a page moves
once to meet its payload's group, but for pages of a payload that a large share of the table has.

Null html is an empty payload; a null url leaves out the target. Bytes that could end a header line are percent-encoded. A
null id orders last. Rows repeated with the smallest id of their payload are all responses. Extra columns are ignored. An empty
table gives no archives, which read as an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import join_groups
from tripmart.workspace import materialise

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Records in one archive at most, and compressed bytes after which a normalised archive ends.
ARCHIVE_RECORDS, ARCHIVE_BYTES = 2_000, 64 << 20
#: Repeated payloads that are broadcast (some 100 bytes each); of more, pages move to meet their payload's group.
BROADCAST_PAYLOADS = 200_000
PIECE = 1 << 20
EMPTY_MEMBER = zlib.compress(b"", 9, 31)
INDEX_LINES = 1_000
LEVEL = 4


def _base32(hex_digest: Column) -> Column:
    """RFC 4648 base32 of 40 hex digits: eight letters from each ten of them."""
    letters = []
    for part in range(4):
        number = F.conv(F.substring(hex_digest, 10 * part + 1, 10), 16, 10).cast("bigint")
        for i in range(8):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(number, 35 - 5 * i).bitwiseAND(31).cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)))


def _urn(identity: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(identity.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", min_payload: int = 0) -> DataFrame:
    """One row per page: ``record``, the text of its WARC record without the blank lines that end it."""
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html")
    ).withColumns({"sha1": F.sha1("html"), "length": F.octet_length("html").cast("bigint")})
    keys = ["sha1", "length"]
    groups = materialise(
        rows.where(F.col("length") >= min_payload)
        .groupBy(*keys)
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1"),
        "payloads",
    )
    if groups.count() <= BROADCAST_PAYLOADS:
        joined = rows.join(F.broadcast(groups), keys, "left")
    else:
        joined = join_groups(rows, groups, keys, "pages")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    url = F.regexp_replace(F.regexp_replace("url", r"\r", "%0D"), r"\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("length").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.concat(F.col("http"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("id"))),
        _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("sha1")))),
        _line("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(F.col("revisit"), _urn(F.col("first_id")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF),
    )
    built = joined.withColumn("revisit", revisit).withColumn("http", http).withColumn("block", block)
    return built.select(F.concat(head, F.col("block")).alias("record"))


def write_monolithic(rows: DataFrame, path: str, per_archive: int = ARCHIVE_RECORDS) -> None:
    """Records as files of one gzip stream each. The writer's record separator is the pair of blank lines that ends a WARC
    record."""
    rows.select("record").write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", per_archive
    ).mode("overwrite").text(path)


def inflate(stream: memoryview):
    """The content of a gzip file, of one member or many, in pieces."""
    engine = zlib.decompressobj(31)
    for at in range(0, len(stream), PIECE):
        data = bytes(stream[at : at + PIECE])
        while data:
            piece = engine.decompress(data, PIECE)
            if piece:
                yield piece
            if engine.eof:
                data = engine.unused_data.lstrip(b"\0")
                engine = zlib.decompressobj(31)
            else:
                data = engine.unconsumed_tail


def split_records(chunks):
    """(header, block) of each record of an uncompressed WARC stream, one at a time."""
    held = bytearray()
    chunks = iter(chunks)

    def need(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    end = (CRLF + CRLF).encode()
    while True:
        searched = 0
        while (at := held.find(end, searched)) < 0:
            searched = max(0, len(held) - 3)
            if not need(len(held) + 1):
                if held.strip():
                    raise ValueError("the archive ends within a record")
                return
        header = bytes(held[:at])
        length = int(header_fields(header)["content-length"])
        if not need(at + 4 + length + 4) or held[at + 4 + length : at + 8 + length] != end:
            raise ValueError("the archive ends within a record")
        yield header, bytes(held[at + 4 : at + 4 + length])
        del held[: at + 8 + length]


def header_fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split(CRLF)[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _member(content: bytes) -> bytes:
    """A gzip member without its last byte, which is NUL."""
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = engine.compress(content) + engine.flush()
    return out[:-1] if out[-1] == 0 else out + EMPTY_MEMBER[:-1]


def normalise(spark: SparkSession, monolithic: str, out: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Rewrite whole-file gzip WARC archives as one member per record, with an index. A stream whose members take more than
    ``archive_bytes`` becomes several archives, each with its own index; a larger record stands alone."""
    files = spark.read.format("binaryFile").load(monolithic).where("length > 0")
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")

    def run(batches):
        names = ["kind", "archive", "seq", "part"]

        def rows(kind, archive, at, parts):
            columns = [[kind] * len(parts), [archive] * len(parts), range(at, at + len(parts)), parts]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                volume, archive = 0, name.split(".")[0]
                offset = seq = held = 0
                parts, lines = [], []

                def index():
                    at = range(0, len(lines), INDEX_LINES)
                    return [_member("".join(x + "\n" for x in lines[i : i + INDEX_LINES]).encode()) for i in at]

                for header, block in split_records(inflate(memoryview(content.as_buffer()))):
                    end = (CRLF + CRLF).encode()
                    part = _member(header + end + block + end)
                    if offset and offset + len(part) + 1 > archive_bytes:
                        yield rows("warc", archive, seq, parts)
                        yield rows("index", archive, 0, index())
                        volume += 1
                        archive = f"{name.split('.')[0]}-{volume}"
                        offset = seq = held = 0
                        parts, lines = [], []
                    fields = header_fields(header)
                    entry = {"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": offset, "length": len(part) + 1}
                    lines.append(json.dumps(entry))
                    parts.append(part)
                    offset, held = offset + len(part) + 1, held + len(part)
                    if held > PIECE:
                        yield rows("warc", archive, seq, parts)
                        seq, held, parts = seq + len(parts), 0, []
                yield rows("warc", archive, seq, parts)
                yield rows("index", archive, 0, index())

    parts = files.mapInArrow(run, "kind string, archive string, seq bigint, part binary")
    parts.sortWithinPartitions("kind", "archive", "seq").select(
        "kind", "archive", F.col("part").cast("string").alias("value")
    ).write.partitionBy("kind", "archive").option("lineSep", "\0").option("maxRecordsPerFile", 0).mode("overwrite").text(out)


def read_index(content: memoryview) -> list[dict]:
    return [json.loads(line) for line in b"".join(inflate(content)).splitlines()]


def read_record(archive: memoryview, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record of a normalised archive."""
    content = b"".join(inflate(archive[offset : offset + length]))
    header, _, rest = content.partition((CRLF + CRLF).encode())
    return header_fields(header), rest[:-4]


READ = "id string, type string, refers_to string, target string, payload_bytes bigint, payload_digest string, payload binary, archive string, offset bigint"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of normalised archives, found by the index: record and referred ids, type, target, length and digest of
    the full payload, the payload (null for a revisit, which has none), and where it lies. A payload that does not have its
    header's digest is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    if "kind" not in files.columns:  # no archives, hence no folders to name
        return spark.createDataFrame([], READ)
    warc = files.where("kind = 'warc'").select("archive", F.col("content").alias("warc"))
    index = files.where("kind = 'index'").select("archive", F.col("content").alias("index"))

    def run(batches):
        columns = [x.split()[0] for x in READ.split(", ")]
        kinds = [pa.int64() if x.endswith("bigint") else pa.binary() if x.endswith("binary") else pa.string() for x in READ.split(", ")]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns)

        for batch in batches:
            for archive, warc, index in zip(batch.column("archive").to_pylist(), batch.column("warc"), batch.column("index"), strict=True):
                content, rows, held = memoryview(warc.as_buffer()), [], 0
                for entry in read_index(memoryview(index.as_buffer())):
                    fields, block = read_record(content, entry["offset"], entry["length"])
                    http, _, payload = block.partition((CRLF + CRLF).encode())
                    size, digest = int(header_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "revisit":
                        payload = None
                    elif (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                        raise ValueError(f"damaged record {fields['warc-record-id']}")
                    rows.append((fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"), fields.get("warc-target-uri"), size, digest, payload, archive, entry["offset"]))
                    held += len(block)
                    if held > PIECE:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    return warc.join(index, "archive").mapInArrow(run, READ)
