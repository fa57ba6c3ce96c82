import base64
import gzip
import hashlib
import json
import random

import pytest

from tripmart.llm import warc
from tripmart.workspace import new_path

SCHEMA = "page_id bigint, url string, html string, id string, record string, sha1 string, archive string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def run(spark, pages, per_archive=warc.ARCHIVE_RECORDS, **options):
    streams, out = new_path(spark, "streams"), new_path(spark, "archives")
    warc.write_monolithic(warc.records(pages, **options), streams, per_archive)
    warc.normalise(spark, streams, out)
    return streams, out


def files(spark, path, pattern="part-*"):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return {r.path: bytes(r.content) for r in found.where("length > 0").collect()}


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


ROWS = [
    (5, "http://a/", "same é"),
    (2, "http://b/\r\nEvil: 1", "same é"),
    (9, None, "same é"),
    (3, "http://c/", None),
    (4, "http://d/", ""),
    (None, "http://e/", "only"),
    (None, "http://f/", "same é"),
    (7, "http://g/", "x\r\n\r\nWARC/1.1\r\n\r\n\r\n\r\n"),
    (8, "http://h/", "twice"),
    (8, "http://h/", "twice"),
]


@pytest.mark.parametrize(("per_archive", "broadcast"), [(1, 100), (3, 0), (2_000, 100), (2_000, 0)])
def test_round_trip(spark, monkeypatch, per_archive, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", broadcast)
    _, out = run(spark, frame(spark, ROWS), per_archive)
    rows = warc.read_archives(spark, out).collect()
    assert len(rows) == len(ROWS)
    payloads = {}
    for i, _, html in ROWS:
        payloads.setdefault(f"<urn:page:{'none' if i is None else i}>", []).append((html or "").encode())
    for r in rows:
        assert any((r.payload_bytes, r.payload_digest) == (len(p), sha(p)) for p in payloads[r.id])
        assert r.payload is None if r.type == "revisit" else sha(bytes(r.payload)) == r.payload_digest
    kinds = sorted((r.id, r.type, r.refers_to) for r in rows if r.payload_digest == sha("same é".encode()))
    two = "<urn:page:2>"
    assert kinds == [(two, "response", None), ("<urn:page:5>", "revisit", two), ("<urn:page:9>", "revisit", two), ("<urn:page:none>", "revisit", two)]
    assert [r.refers_to for r in rows if r.id == "<urn:page:4>"] == ["<urn:page:3>"]  # null and empty are equal payloads
    assert [r.type for r in rows if r.id == "<urn:page:8>"] == ["response"] * 2
    assert [r.target for r in rows if r.id == two] == ["http://b/%0D%0AEvil: 1"]
    assert [r.target for r in rows if r.id == "<urn:page:9>"] == [None]


def test_small_payloads_are_all_responses(spark):
    _, out = run(spark, frame(spark, ROWS), min_payload=6)
    types = {r.id: r.type for r in warc.read_archives(spark, out).collect()}
    assert types["<urn:page:4>"] == "response" and types["<urn:page:5>"] == "revisit"


def test_members_are_plain_gzip_and_the_index_leads_to_each(spark):
    draw = random.Random(1)
    rows = [(i, f"http://{i}/", "".join(draw.choice("abcdef \n") for _ in range(draw.randrange(3_000)))) for i in range(120)]
    rows.append((500, "http://large/", "large " * 3_000_000))  # 18 MB: its member does not end with NUL by itself
    streams, out = run(spark, frame(spark, rows).repartition(2), 40)
    whole = {content for content in map(gzip.decompress, files(spark, streams).values())}
    archives = {p.split("archive=")[1].split("/")[0]: c for p, c in files(spark, f"{out}/kind=warc").items()}
    indexes = {p.split("archive=")[1].split("/")[0]: c for p, c in files(spark, f"{out}/kind=index").items()}
    assert {gzip.decompress(c) for c in archives.values()} == whole
    assert set(archives) == set(indexes) and sum(len(c) for c in whole) > 18_000_000
    for name, index in indexes.items():
        end = 0
        for entry in map(json.loads, gzip.decompress(index).splitlines()):
            assert entry["offset"] == end
            end += entry["length"]
            header, block = warc.read_record(memoryview(archives[name]), entry["offset"], entry["length"])
            assert header["warc-record-id"] == entry["id"] and int(header["content-length"]) == len(block)
        assert end == len(archives[name])


def test_a_long_stream_becomes_archives_of_bounded_size(spark):
    draw = random.Random(2)
    pages = [(i, None, "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.choice((200, 9_000, 60_000))))) for i in range(60)]
    streams, out = new_path(spark, "streams"), new_path(spark, "archives")
    warc.write_monolithic(warc.records(frame(spark, pages).repartition(1)), streams)
    warc.normalise(spark, streams, out, archive_bytes=40_000)
    archives = files(spark, f"{out}/kind=warc")
    assert len(archives) > 5 and len(files(spark, f"{out}/kind=index")) == len(archives)
    assert sum(len(c) > 40_000 for c in archives.values()) == 0
    rows = {r.id: sha(bytes(r.payload)) for r in warc.read_archives(spark, out).collect()}
    assert rows == {f"<urn:page:{i}>": sha(html.encode()) for i, _, html in pages}


def test_a_session_that_limits_records_per_file(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 2)
    try:
        _, out = run(spark, frame(spark, ROWS).repartition(1))
        assert warc.read_archives(spark, out).count() == len(ROWS)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_inflate_and_split_in_small_pieces():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    stream = gzip.compress(record * 3) + gzip.compress(record) + b"\0\0"
    assert b"".join(warc.inflate(memoryview(stream))) == record * 4
    assert [b for _, b in warc.split_records([bytes([c]) for c in record * 4])] == [b"a\r\n\r\n"] * 4
    with pytest.raises(ValueError):
        list(warc.split_records([record[:-3]]))


def test_empty(spark):
    _, out = run(spark, frame(spark, ROWS).limit(0))
    assert warc.read_archives(spark, out).count() == 0
