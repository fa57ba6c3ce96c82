"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1, given as points joined by straight lines. Its integral is the
source's weight in the mix. Targets share ``share`` times all words by weight; a target stops at ``repeat`` times its
source's size, and the excess is shared again by weight until none is above.

Within a source, documents stand in the order of a seeded hash and are read pass after pass. A copy is taken if its middle
lies before the target, so a source's words miss the target by half a document at most, and no document is taken more
than ``repeat`` times. The point of the schedule at which the integral reaches the words read so far is the copy's training
position; sorting by it gives the order of training.

Running totals are sums per (source, hash range) carried on over the ranges, then a window within a range: no task holds a
source. The number of ranges is the square root of the number of documents, so both windows stay small. Only ids, sources
and sizes are shuffled; ``arranged`` shuffles texts once, by position.

Size is the number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0). Documents of size 0 are taken while their middle is before
the target; they add nothing. A null source is a source of its own, the last. Null ids order first. Repeated rows are
documents of their own, next to each other. Empty tables give empty tables. ``plan`` keeps no extra columns; ``arranged``
keeps all and replaces ``training_position`` and ``training_copy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.workspace import materialise

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEAT = 2
SEED = 0
#: Schedules that repeat over the sources: (time, factor of the weight); each has the integral 1.
SHAPES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def words(text: Column) -> Column:
    """Number of words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _order_key(identity: Column, seed: int, without: Column | None = None) -> Column:
    """``without`` stands for an id that is null."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null") if without is None else without)))


def _row_hashes(identity: Column, source: Column, text: Column) -> list[Column]:
    """The halves of a hash of a document; equal for repeated rows only."""
    parts = [identity.isNull(), source.isNull(), text.isNull(), identity, source, text]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def sources(sizes: DataFrame, weights=WEIGHTS, shapes=SHAPES, share=SHARE, repeat=REPEAT) -> DataFrame:
    """``sizes`` has one row per source: source, source_size. Adds weight, target and the schedule: knots ``at``, weights
    ``height`` there, and ``area``, the integral up to each. One row per source meets in one task."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))
    base = pick([float(w) for w in weights])
    at = F.element_at(F.array(*[F.array(*[F.lit(float(t)) for t, _ in s]) for s in shapes]), (F.col("rank") % len(shapes) + 1).cast("int"))
    factor = F.element_at(F.array(*[F.array(*[F.lit(float(h)) for _, h in s]) for s in shapes]), (F.col("rank") % len(shapes) + 1).cast("int"))
    scheduled = ranked.withColumn("base", base).withColumn("at", at).withColumn(
        "height", F.transform(factor, lambda h: h * F.col("base"))
    )
    steps = F.transform(
        F.sequence(F.lit(1), F.size("at") - 1),
        lambda i: (F.element_at("at", i + 1) - F.element_at("at", i))
        * (F.element_at("height", i + 1) + F.element_at("height", i))
        / 2,
    )
    area = F.transform(
        F.sequence(F.lit(0), F.size("at") - 1),
        lambda i: F.aggregate(F.slice(F.col("steps"), F.lit(1), i), F.lit(0.0), lambda a, x: a + x),
    )
    weighed = (
        scheduled.withColumn("steps", steps)
        .withColumn("area", area)
        .withColumn("weight", F.element_at("area", -1))
        .drop("steps", "base")
    )
    # sources that fill up do so in the order of how little they can take for their weight
    most = (F.col("source_size") * repeat).cast("double")
    filling = Window.orderBy((most / F.col("weight")).asc(), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    before = lambda x: F.coalesce(F.sum(x).over(filling), F.lit(0.0))
    rate = (F.sum("source_size").over(everything) * share - before(most)) / (
        F.sum("weight").over(everything) - before(F.col("weight"))
    )
    return (
        weighed.withColumn("rate", rate)
        .withColumn("level", F.max(F.when(most > F.col("weight") * F.col("rate"), F.col("rate"))).over(everything))
        .withColumn("target", F.least(most, F.coalesce(F.col("weight") * F.col("level"), most)))
        .select("source", "source_size", "weight", "target", "at", "height", "area")
    )


def _position(read: Column) -> Column:
    """Where the schedule's integral, scaled to the target, reaches ``read`` words."""
    demand = F.least(read / F.col("target"), F.lit(1.0)) * F.element_at("area", -1)
    i = F.greatest(F.lit(1), F.least(F.size(F.filter("area", lambda a: a <= demand)), F.size("area") - 1))
    low, high = F.element_at("height", i), F.element_at("height", i + 1)
    t0, t1 = F.element_at("at", i), F.element_at("at", i + 1)
    ahead = F.greatest(demand - F.element_at("area", i), F.lit(0.0))
    root = F.sqrt(F.greatest(low * low + 2 * (high - low) / (t1 - t0) * ahead, F.lit(0.0)))
    step = F.when(low + root > 0, 2 * ahead / (low + root)).otherwise(F.lit(0.0))
    return F.least(t0 + step, t1)


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    shapes=SHAPES,
    share: float = SHARE,
    repeat: int = REPEAT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, source, order_key, size, source_size, target, copies, taken (words), positions (one
    per copy, ascending), hash_a and hash_b (of the document; they order rows of one key, id and size)."""
    key = _order_key(F.col(id_col), seed)
    return _plan(docs, id_col, text_col, source_col, weights, shapes, share, repeat, key)


def _plan(docs, id_col, text_col, source_col, weights, shapes, share, repeat, order_key: Column) -> DataFrame:
    hashes = _row_hashes(F.col(id_col), F.col(source_col), F.col(text_col))
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        order_key.alias("order_key"),
        words(F.col(text_col)).alias("size"),
        hashes[0].alias("hash_a"),
        hashes[1].alias("hash_b"),
    )
    sized = materialise(sized, "sizes")
    ranges = max(1, round(sized.count() ** 0.5))
    slot = F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("bigint") * ranges / F.lit(1 << 32)).cast("int")
    sized = sized.withColumn("slot", slot).withColumn("is_null", F.col("source").isNull()).withColumn(
        "name", F.coalesce("source", F.lit(""))
    )
    slots = materialise(
        sized.groupBy("is_null", "name", "source", "slot").agg(F.sum("size").alias("slot_size")), "slots"
    )
    totals = slots.groupBy("source").agg(F.sum("slot_size").alias("source_size"))
    mixed = materialise(sources(totals, weights, shapes, share, repeat), "sources")
    earlier = Window.partitionBy("is_null", "name").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    known = mixed.withColumn("is_null", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    offsets = (
        slots.withColumn("before", F.coalesce(F.sum("slot_size").over(earlier), F.lit(0)))
        .drop("source", "slot_size")
        .join(known.drop("source"), ["is_null", "name"])
    )
    inside = (
        Window.partitionBy("is_null", "name", "slot")
        .orderBy("order_key", "id", "size", "hash_a", "hash_b")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    read = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = sized.join(materialise(offsets, "offsets"), ["is_null", "name", "slot"]).withColumn("read", read)
    starts = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(repeat - 1)), lambda k: F.col("read") + k * F.col("source_size")),
        lambda start: start * 2 + F.col("size") <= F.col("target") * 2,
    )
    return (
        placed.withColumn("starts", starts)
        .withColumn("copies", F.size("starts"))
        .select(
            "id",
            "source",
            "order_key",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            F.transform("starts", lambda start: F.when(F.col("target") > 0, _position(start)).otherwise(F.lit(0.0))).alias(
                "positions"
            ),
            "hash_a",
            "hash_b",
        )
    )


def arranged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    shapes=SHAPES,
    share: float = SHARE,
    repeat: int = REPEAT,
    seed: int = SEED,
    planned: DataFrame | None = None,
) -> DataFrame:
    """The mixed documents in the order of training: a row per copy, range-sorted by ``training_position``. As planned,
    but rows without id are ordered by a hash of their text, so they stand all over their source. Of repeated rows each
    has positions of its own. ``planned``: a plan of these documents, which then holds as it is."""
    key = _order_key(F.col(id_col), seed, F.concat(F.lit("null:"), F.coalesce(F.md5(text_col), F.lit("null"))))
    if planned is None:
        planned = _plan(docs, id_col, text_col, source_col, weights, shapes, share, repeat, key)
    places = materialise(
        planned.where("copies > 0")
        .groupBy(F.col("hash_a").alias("_a"), F.col("hash_b").alias("_b"))
        .agg(F.sort_array(F.collect_list("positions")).alias("_places")),
        "places",
    )
    names = [c for c in docs.columns if c not in ("training_copy", "training_position")]
    hashes = _row_hashes(F.col(id_col), F.col(source_col), F.col(text_col))
    # the user's columns in one struct: none can have the name of a working column
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"), hashes[0].alias("_a"), hashes[1].alias("_b"))
    joined = rows.join(places.hint("merge"), ["_a", "_b"])
    nth = F.row_number().over(Window.partitionBy("_a", "_b").orderBy("_a"))
    copies = joined.withColumn("_positions", F.get("_places", nth - 1)).select(
        *[F.col("d").getField(c).alias(c) for c in names], F.posexplode("_positions").alias("training_copy", "training_position")
    )
    return copies.repartitionByRange("training_position", id_col).sortWithinPartitions("training_position", id_col)
