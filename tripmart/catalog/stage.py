"""Tables that several queries read, written once per session and input folder into the shared folder."""

from __future__ import annotations

from dataclasses import dataclass, field
from threading import RLock

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.trips import derived_trips
from tripmart.operators.cleaning import standardise, trip_statistics
from tripmart.plans.landing import keep_state, land_trips, landed_path, state_path, zone_state
from tripmart.plans.rollups import TOGETHER, build_rollups, grain_of, scan_rollup
from tripmart.plans.warehouse import build_warehouse
from tripmart.sources.sinks import write_files
from tripmart.sources.tables import scan_table, scan_trips
from tripmart.workspace import new_path

LOAD_DATE = (2026, 4)

_lock = RLock()
_landed: dict[tuple[str, str], str] = {}
_suppliers: dict[tuple[str, str, str], str] = {}
_rollups: dict[tuple[str, str, tuple[str, ...]], str] = {}
_warehouses: dict[tuple[str, str], "Warehouse"] = {}


@dataclass(frozen=True)
class Warehouse:
    base: str
    counts: dict[str, int] = field(hash=False)


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the landed batch."""
    with _lock:
        key = _key(spark, sf_dir)
        if key not in _landed:
            zone = new_path(spark, "raw")
            land_trips(derived_trips(spark, sf_dir), zone, *LOAD_DATE)
            keep_state(spark, zone, *LOAD_DATE)
            _landed[key] = landed_path(zone, *LOAD_DATE)
        return _landed[key]


#: The encoding of a supplier's file below ``encoded/``, by key, and a sentence in it: fixed values.
ENCODED = (
    ("utf-8", "Façade à Besançon, garçon là-bas"),
    ("utf-16-le", "Straße über Öl"),
    ("utf-16-be", "Mañana señor"),
    ("windows-1252", "Les élèves français étaient là où la forêt était brûlée"),
    ("koi8-r", "Поездка по городу оплачена наличными в пятницу"),
    ("windows-1251", "Поездка по городу оплачена наличными в пятницу"),
    ("ascii", "plain words"),
)


def _encoded(keyed: DataFrame) -> DataFrame:
    """Lines of bytes in the encoding of their key; a text file holds them as they are."""
    text = F.array(*[F.lit(sentence) for _, sentence in ENCODED])
    kind = F.array(*[F.lit(name) for name, _ in ENCODED])
    nth = (F.col("s_suppkey") % len(ENCODED)).cast("int")

    def run(batches):
        for batch in batches:
            names, lines = batch.column("kind").to_pylist(), batch.column("line").to_pylist()
            # a line ends with one byte: it gets another one in front, where units have two
            half = {"utf-16-le": b" ", "utf-16-be": b"\0"}
            raw = [line.encode(name) + half.get(name, b"") for name, line in zip(names, lines, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("s_suppkey"), pa.array(raw, pa.binary())], ["s_suppkey", "line"])

    lines = keyed.select("s_suppkey", F.get(kind, nth).alias("kind"), F.concat_ws(" ", F.get(text, nth), "line").alias("line"))
    return lines.mapInArrow(run, "s_suppkey bigint, line binary")


#: Suppliers whose files lie in one folder: the task that lists it meets no more.
SUPPLIERS_PER_FOLDER = 1000


def supplier_files(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A folder with one small file per supplier, its key in the name. ``plain``: ``csv`` for even keys, ``txt`` for odd ones;
    ``marked``: text, where every seventh file is not UTF-8; ``encoded``: text in several encodings."""
    with _lock:
        key = (*_key(spark, sf_dir), kind)
        if key not in _suppliers:
            base = f"{new_path(spark, 'suppliers')}/{kind}"
            keyed = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.col("s_name").alias("line"))
            as_text = F.coalesce(F.col("line"), F.lit("")).cast("binary")
            if kind == "plain":
                even, odd = keyed.where("s_suppkey % 2 = 0"), keyed.where("s_suppkey % 2 <> 0")
                # a CSV of one column has no line for a null
                record = F.when(F.col("line").isNotNull(), F.to_csv(F.struct("line")).cast("binary"))
                lines = even.select("s_suppkey", record.alias("line")).unionAll(odd.select("s_suppkey", as_text.alias("line")))
            elif kind == "marked":
                broken = F.concat(F.unhex(F.lit("FF")), F.col("line").cast("binary"))
                marked = F.coalesce(F.when(F.col("s_suppkey") % 7 == 0, broken).otherwise(as_text), as_text)
                lines = keyed.select("s_suppkey", marked.alias("line"))
            elif kind == "encoded":
                lines = _encoded(keyed)
            else:
                raise ValueError(f"no files of kind {kind}")
            name = F.coalesce(F.col("s_suppkey").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
            group = F.coalesce(F.floor(F.col("s_suppkey") / SUPPLIERS_PER_FOLDER), F.lit(0))
            extension = F.when(F.lit(kind == "plain") & (F.col("s_suppkey") % 2 == 0), "csv").otherwise("txt")
            path = F.concat(F.lit("group="), group, F.lit("/part-s_suppkey="), name, F.lit("."), extension)
            write_files(lines.select(path.alias("path"), "line"), base)
            _suppliers[key] = base
        return _suppliers[key]


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians and bounds of the landed trips, from the state kept when they landed."""
    folder = raw_folder(spark, sf_dir)
    zone = folder.removesuffix(landed_path("", *LOAD_DATE))
    state = zone_state(spark, landed_path(state_path(zone), *LOAD_DATE))
    return trip_statistics(standardise(scan_trips(spark, folder)), state=state)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_trips(spark, raw_folder(spark, sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    with _lock:
        key = _key(spark, sf_dir)
        if key not in _warehouses:
            base = new_path(spark, "warehouse")
            _warehouses[key] = Warehouse(base, build_warehouse(raw_trips(spark, sf_dir), base))
        return _warehouses[key]


def rollup(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Partial aggregates of the fact that have these columns. Grains are written when a report first asks for one of those that are
    filled together."""
    together = next(group for group in TOGETHER if grain_of(*columns) in group)
    with _lock:
        key = (*_key(spark, sf_dir), together)
        if key not in _rollups:
            path = new_path(spark, "rollups")
            build_rollups(table(spark, sf_dir, "fact_trips"), path, together)
            _rollups[key] = path
    return scan_rollup(spark, _rollups[key], *columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, warehouse(spark, sf_dir).base, name)
