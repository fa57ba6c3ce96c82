import bz2
import gzip
import hashlib
import random
from urllib.parse import unquote

import pytest

from tests.conftest import plan_of
from tripmart import schemas as S
from tripmart.operators import checks
from tripmart.plans.landing import land_trips, landing_gate
from tripmart.sources import encodings, files, listing, sinks, tables
from tripmart.workspace import new_path, shared_root


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "good.csv").write_bytes("a,b\n1,é\n".encode())
    (tmp_path / "bad.csv").write_bytes(b"a,b\n1,\xe9\n2,\xff\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "a name.csv").write_bytes(b"a\n\xfe\n")
    (tmp_path / "notes.TXT").write_bytes(b"x" * 50)
    (tmp_path / "big.JSON").write_bytes(b"{}" * 500)
    return tmp_path


def by_name(df):
    return {unquote(r["path"]).rsplit("/", 1)[1]: r for r in df.collect()}


def test_listing_does_not_read_contents(spark, folder):
    listing = files.list_files(spark, str(folder))
    assert {n: r["length"] for n, r in by_name(listing).items()} == {p.name: p.stat().st_size for p in folder.iterdir()}
    assert "content" not in plan_of(listing)


def test_file_gate(spark, folder):
    rows = by_name(files.file_gate(files.list_files(spark, str(folder)), min_bytes=40))
    assert {n for n, r in rows.items() if not r["extension_ok"]} == {"notes.TXT"}
    assert {n for n, r in rows.items() if r["passed"]} == {"big.JSON"}
    assert not any(r["size_ok"] for r in files.file_gate(files.list_files(spark, str(folder))).collect())


def test_md5_of_every_file_in_one_way(spark, folder):
    (folder / "large.tsv").write_bytes(b"0123456789abcdef" * 100_000)
    sums = files.file_md5(spark, str(folder))
    assert {n: r["md5"] for n, r in by_name(sums).items()} == {
        p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in folder.iterdir()
    }


def tree(content, block, fan):
    level = [hashlib.sha256(content[i : i + block]).digest() for i in range(0, len(content), block)] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"".join(level[i : i + fan])).digest() for i in range(0, len(level), fan)]
    return level[0].hex()


@pytest.mark.parametrize(("block", "fan"), [(1 << 20, 256), (100, 3), (7, 2)])
def test_tree_digests_of_files_larger_than_a_value_may_be(spark, folder, block, fan):
    (folder / "large.tsv").write_bytes(random.Random(1).randbytes(12_345))
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        rows = by_name(files.file_tree_digest(spark, str(folder), block=block, fan=fan))
        sums = by_name(files.file_md5(spark, str(folder)))
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert {n: r["tree_digest"] for n, r in rows.items()} == {p.name: tree(p.read_bytes(), block, fan) for p in folder.iterdir()}
    assert {n: r["blocks"] for n, r in rows.items()} == {p.name: max(1, -(-p.stat().st_size // block)) for p in folder.iterdir()}
    assert sums["large.tsv"]["md5"] == hashlib.md5((folder / "large.tsv").read_bytes()).hexdigest()


def test_listing_of_a_deep_tree(spark, tmp_path):
    wanted = {}
    for name in ("a/b/c/1.csv", "a/b/2.csv", "a/x=1/3.txt", "_temporary/4.csv", ".hidden/5.csv", "_k=2/6.csv", "a/_7.csv", "8 +%20é.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode() if "2" in name else b"")
        if name not in ("_temporary/4.csv", ".hidden/5.csv", "a/_7.csv"):
            wanted[f"file://{tmp_path}/{name}"] = (tmp_path / name).stat().st_size
    (tmp_path / "empty" / "folder").mkdir(parents=True)
    rows = files.list_files(spark, str(tmp_path)).collect()
    assert {r.path: r.length for r in rows} == wanted and all(r.modified_at for r in rows)
    assert {r.path for r in files.list_files(spark, str(tmp_path), "[!1].{csv,txt}").collect()} == {p for p in wanted if p[-5:] in ("2.csv", "3.txt", "6.csv")}
    assert [r.length for r in files.list_files(spark, str(tmp_path / "a/b/2.csv")).collect()] == [9]
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "no such"))


def test_no_list_of_names_on_the_driver(spark, folder, monkeypatch):
    """Of the whole listing only numbers and schemas pass the driver."""
    for method in ("collect", "toPandas", "inputFiles", "toLocalIterator"):
        monkeypatch.setattr(type(spark.range(1)), method, lambda *_: pytest.fail("rows on the driver"))
    files.file_gate(files.list_files(spark, str(folder)))


def sample(language):
    return {
        "fr": "Les élèves français étaient là où la forêt brûlée s'étend, à côté du château. " * 3,
        "cs": "Příliš žluťoučký kůň úpěl ďábelské ódy a řeka tekla dál. " * 3,
        "ru": "Поездка по городу оплачена наличными в пятницу, без чаевых. " * 3,
        "el": "Η διαδρομή στην πόλη πληρώθηκε με μετρητά την Παρασκευή. " * 3,
        "en": "plain words and numbers 12.50 " * 3,
        "zh": "城市里的行程用现金支付。\n" * 3,
    }[language]


ENCODED = [
    ("fr", "utf-8", "utf-8"), ("zh", "utf-8", "utf-8"), ("en", "ascii", "ascii"), ("fr", "utf-8-sig", "utf-8"), ("fr", "utf-16-le", "utf-16-le"),
    ("fr", "utf-16-be", "utf-16-be"), ("ru", "utf-16", "utf-16-le"), ("en", "utf-32-le", "utf-32-le"), ("ru", "utf-32-be", "utf-32-be"),
    ("fr", "windows-1252", "windows-1252"), ("cs", "windows-1250", "windows-1250"), ("ru", "windows-1251", "windows-1251"), ("ru", "koi8-r", "koi8-r"),
    ("ru", "iso-8859-5", "iso-8859-5"), ("el", "windows-1253", "windows-1253"), ("fr", "cp850", "cp850"),
]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_encodings_of_files_however_they_are_cut(spark, tmp_path, size):
    for i, (language, encoding, _) in enumerate(ENCODED):
        (tmp_path / f"{i}.txt").write_bytes(sample(language).encode(encoding))
    (tmp_path / f"{len(ENCODED)}.txt").write_bytes(b"")
    learned = encodings.learn_pairs(spark.createDataFrame([(sample("fr") + " été où çà",), (sample("cs"),)], "text string"))
    found = encodings.detect_encodings(files.list_files(spark, str(tmp_path)), encodings.likelihoods(spark, learned), size)
    rows = {int(n[:-4]): r for n, r in by_name(found).items()}
    assert [rows[i]["encoding"] for i in range(len(ENCODED))] == [name for *_, name in ENCODED]
    assert all(0.5 < r["confidence"] <= 1 for r in rows.values())
    assert rows[len(ENCODED)]["encoding"] == "ascii"


def test_utf8_states_are_those_of_a_decoder(spark, tmp_path):
    """Is a file valid? Random bytes of all kinds, cut into ranges of four."""
    draw = random.Random(4)
    parts = [b"a", "é".encode(), "日".encode(), "😀".encode(), b"\x80", b"\xe9", b"\xed\xa0\x80", b"\xf0\x8f", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\xe2\x82"]
    wanted = []
    for i in range(150):
        content = b"".join(draw.choices(parts[: 4 if i % 2 else None], k=draw.randrange(1, 9)))
        (tmp_path / f"{i}.txt").write_bytes(content)
        try:
            wanted.append(bool(content.decode()))
        except UnicodeDecodeError:
            wanted.append(False)
    found = encodings.detect_encodings(files.list_files(spark, str(tmp_path)), encodings.likelihoods(spark), 4)
    rows = {int(n[:-4]): r["encoding"] in ("utf-8", "ascii") for n, r in by_name(found).items()}
    assert [rows[i] for i in range(150)] == wanted and 20 < sum(wanted) < 130


def test_utf8_check_covers_whole_files(spark, folder):
    (folder / "late.csv").write_bytes(b"a\n" + b"1\n" * 100_000 + b"\xff\n")
    rows = by_name(files.file_utf8(spark, str(folder)))
    assert {n: r["bad_lines"] for n, r in rows.items()} == {"good.csv": 0, "bad.csv": 2, "empty.csv": 0, "a name.csv": 1, "late.csv": 1}
    assert {n for n, r in rows.items() if r["is_utf8"]} == {"good.csv", "empty.csv"}


@pytest.mark.parametrize("size", [3, 10, 1 << 20])
def test_utf8_lines_however_a_file_is_cut(spark, tmp_path, monkeypatch, size):
    """Lines with all ends, across ranges and packed, are checked by tasks; Spark's text source would list every name on the driver."""
    from pyspark.sql.readwriter import DataFrameReader

    draw, wanted = random.Random(5), {}
    parts = [b"a", "é".encode(), "😀".encode(), b"\xff", b"\xe2\x82", b"\n", b"\r", b"\r\n"]
    for i in range(80):
        content = b"".join(draw.choices(parts, k=draw.randrange(0, 30)))
        (tmp_path / f"{i}.txt").write_bytes(content)
        wanted[f"{i}.txt"] = sum(line.decode(errors="replace").encode() != line for line in content.replace(b"\r", b"\n").split(b"\n"))
    for name, pack in (("p.gz", gzip.compress), ("p.bz2", bz2.compress)):
        (tmp_path / name).write_bytes(pack(b"a\n\xff\nb\n\xc0") * 2)
        wanted[name] = 4
    monkeypatch.setattr(DataFrameReader, "text", lambda *_: pytest.fail("names on the driver"))
    rows = by_name(files.file_utf8(spark, str(tmp_path), None, size=size))
    assert {n: r["bad_lines"] for n, r in rows.items()} == wanted and 10 < sum(wanted.values())
    assert all(r["is_utf8"] == (r["bad_lines"] == 0) for r in rows.values())


def test_neighbouring_ranges_share_an_open_file(spark, folder):
    listed = files.list_files(spark, str(folder), "big.JSON").select("path", "length")
    rows = listing.read_ranges(listing.spread(listed, listing.ranges(listed, 100)), lambda file, row: (file.tell(), file.read(100))[0], "at", "bigint")
    assert {r.number: r.at for r in rows.collect()} == {i: 100 * i for i in range(10)}


def test_few_folders_are_listed_by_many_tasks(spark, tmp_path):
    """What a folder holds is not known before: four folders are not one task's."""
    for i in range(4):
        (tmp_path / str(i)).mkdir()
        (tmp_path / str(i) / "x.csv").write_bytes(b"")
    frame = type(spark.range(1))
    seen, real = [], frame.repartition
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frame, "repartition", lambda self, n, *by: (seen.append(n), real(self, n, *by))[1])
        assert files.list_files(spark, str(tmp_path)).count() == 4
    assert seen == [1, 4]


def test_gate_collects_every_failure_before_it_raises(spark, folder):
    listed = files.file_gate(files.list_files(spark, str(folder)), min_bytes=40)
    rows = spark.createDataFrame([("csv", 5, True), ("parquet", 0, False)], "format string, n bigint, readable boolean")
    verdict = checks.ingest_gate(listed, rows, min_rows=10, encodings=files.file_utf8(spark, str(folder)))
    assert {r["check_name"]: (r["observed"], r["passed"]) for r in verdict.collect()} == {
        "files_present": (6, True),
        "bad_extensions": (1, False),
        "small_files": (4, False),
        "unreadable": (1, False),
        "row_count": (5, False),
        "not_utf8": (2, False),
    }
    with pytest.raises(checks.GateFailed, match="5 check.*bad_extensions.*not_utf8.*row_count.*small_files.*unreadable"):
        checks.require_passed(verdict)
    checks.require_passed(checks.row_gate(spark.range(10), 10))


def test_landing_replaces_only_its_own_month(spark, make, tmp_path):
    zone = str(tmp_path / "raw")
    one, two = make([{"fare_amount": 1.0}]), make([{"fare_amount": 2.0}, {"fare_amount": 3.0}])
    assert sinks.land_batch(one, zone, 2026, 4) == 1
    assert sinks.land_batch(one, zone, 2026, 5) == 1
    assert sinks.land_batch(two, zone, 2026, 4) == 2
    assert sinks.land_batch(one, zone, 2026, 6) == 1
    assert sinks.land_batch(one.limit(0), zone, 2026, 6) == 0  # an empty batch replaces too
    landed = tables.scan_trips(spark, zone)
    assert sorted((r["month"], r["fare_amount"]) for r in landed.collect()) == [(4, 2.0), (4, 3.0), (5, 1.0)]
    assert "PartitionFilters: [isnotnull(month" in plan_of(landed.where("month = 5"))


def test_csv_round_trip_and_sample(spark, make, tmp_path):
    from datetime import datetime

    trips = make([{"VendorID": 1, "fare_amount": 0.1, "tpep_pickup_datetime": datetime(2023, 3, 12, 2, 30)}, {"tip_amount": 1e-9}])
    path = str(tmp_path / "csv")
    assert sinks.write_csv(trips, path) == 2
    back = tables.read_csv(spark, path, S.RAW_TRIPS)
    assert back.schema == S.RAW_TRIPS
    assert sorted(map(str, back.collect())) == sorted(map(str, trips.collect()))
    sample = tables.csv_sample(spark, path, 1)
    assert sample.columns == trips.columns and sample.count() == 1


def test_schema_report(spark):
    rows = tables.schema_report(spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).collect()
    assert [tuple(r) for r in rows] == [(1, "a", "int", 2, 2, False), (2, "b", "string", 2, 1, True)]


def test_writes_go_to_the_folder_the_session_names(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    first, second = new_path(spark, "x"), new_path(spark, "x")
    assert first.startswith(root) and first != second


def verdicts(spark, path, **limits):
    return {r["check_name"]: (r["observed"], r["passed"]) for r in landing_gate(spark, str(path), **limits).collect()}


def test_landing_gate_judges_csv_and_parquet_and_survives_bad_folders(spark, make, tmp_path):
    trips = make([{"fare_amount": 1.0}, {"fare_amount": 2.0}])
    sinks.write_csv(trips, str(tmp_path / "both" / "csv"))
    trips.write.parquet(str(tmp_path / "both" / "parquet"))
    found = verdicts(spark, tmp_path / "both", min_rows=4, min_bytes=1)
    assert all(passed for _, passed in found.values()) and found["row_count"] == (4, True)
    (tmp_path / "both" / "broken.parquet").write_bytes(b"no parquet")
    (tmp_path / "both" / "latin.csv").write_bytes(b"a\n\xe9\n")
    found = verdicts(spark, tmp_path / "both", min_rows=4, min_bytes=1)
    assert found["unreadable"] == (1, False) and found["not_utf8"] == (1, False) and found["row_count"] == (3, False)
    (tmp_path / "nothing").mkdir()
    for path in (tmp_path / "nothing", tmp_path / "nowhere"):
        found = verdicts(spark, path)
        assert found["files_present"] == (0, False) and found["row_count"] == (0, False)


def test_drifted_batches_are_brought_to_the_declared_schema(spark, make, tmp_path):
    trips = make([{"VendorID": 1, "airport_fee": 1.25, "passenger_count": 2.0}])
    other = trips.selectExpr("CAST(VendorID AS INT) AS vendorid", "airport_fee AS Airport_fee", "'x' AS passenger_count", "1 AS more")
    land_trips(trips, str(tmp_path), 2026, 4)
    landed = land_trips(other, str(tmp_path), 2026, 5)
    assert landed.schema == S.RAW_TRIPS
    rows = tables.scan_trips(spark, str(tmp_path)).select("month", "VendorID", "airport_fee", "passenger_count").collect()
    assert sorted(map(tuple, rows)) == [(4, 1, 1.25, 2.0), (5, 1, 1.25, None)]
