"""Mixing sources to target weights along a time-varying curriculum, in built-in functions only.

Every source has a weight that changes linearly over training, from ``rise`` to
``2 - rise`` times its mean. Its cumulative demand after a share ``t`` of training is the
integral of the weight. The documents of a source stand in an order by checksum; the
words before a document are inverted through the demand to the time at which the mix
reaches it, and the mix is sorted by that position in ranges.

Running sums are taken in two steps, inside slots of a source and over the sums of the
slots, so a source of any size is spread over tasks.

Defined cases: a null text has no words; a null source is a source of its own, after all
others; documents without words are placed but take nothing; repeated rows count as often
as they stand there; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.llm.common import packed, row_key, same_row, text_or_empty, word_count
from notepairs.session import clear, stage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Weight at the start relative to the mean, by place in ``WEIGHTS``: light sources come early.
RISE = (1.5, 1.0, 0.5)


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, null last, without gathering the sources in one task.

    Sorted ranges are numbered inside and shifted by the sizes of the ranges before them;
    the driver sees one number per range.
    """
    last = F.col("source").isNull()
    ranges = stage(
        sources.repartitionByRange(last, F.col("source")).sortWithinPartitions(last, F.col("source"))
        .withColumn("range", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    )
    sizes = {r["range"]: (r["n"], r["low"]) for r in ranges.groupBy("range").agg(F.count("*").alias("n"), F.min("row").alias("low")).collect()}
    shift, before = {}, 0
    for at in sorted(sizes):
        shift[at], before = before - sizes[at][1], before + sizes[at][0]
    if not shift:
        return ranges.withColumn("rank", F.lit(0).cast("long")).drop("range", "row")
    moves = F.create_map(*[F.lit(x) for pair in shift.items() for x in pair])
    return ranges.withColumn("rank", F.col("row") + moves[F.col("range")]).drop("range", "row")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to ``source, source_size``.

    The targets share the words of all sources by weight; a target stops at ``max_epochs``
    times its source, and the excess is shared again by weight until none is above. Each
    round is one small aggregation, and the driver sees two numbers of it.
    """
    table = F.array(*[F.lit(w) for w in weights])
    weighted = ranked(sources).withColumn("weight", F.get(table, F.pmod("rank", F.lit(len(weights))).cast("int")))
    known = stage(weighted.withColumn("open", F.lit(True)))
    cap = F.lit(max_epochs) * F.col("source_size")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    while True:
        sums = known.agg(F.sum(F.when(F.col("open"), F.col("weight"))), F.sum(F.when(~F.col("open"), cap))).first()
        share = F.lit(float(total - (sums[1] or 0))) * F.col("weight") / F.lit(float(sums[0] or 1))
        over = F.col("open") & (share > cap)
        if known.where(over).isEmpty():
            break
        # The level only rises, so a source at its cap stays there.
        known, done = stage(known.withColumn("open", F.col("open") & ~over)), known
        clear(done)
    return known.withColumn("target", F.when(F.col("open"), share).otherwise(cap.cast("double"))).drop("open")


def position(share: Column, rise: Column) -> Column:
    """Time at which a linear weight from ``rise`` to ``2 - rise`` has spent ``share`` of its demand.

    The demand is ``rise * t + (1 - rise) * t * t``; this is its inverse on 0 to 1.
    """
    bend = 1 - rise
    root = F.try_divide(F.sqrt(rise * rise + 4 * bend * share) - rise, 2 * bend)
    return F.when(bend == 0, share).otherwise(F.least(F.lit(1.0), root))


def mixture(
    docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, rise: tuple[float, ...] = RISE, max_epochs: int = MAX_EPOCHS,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """``doc_id, row_key, size, source, source_size, target, epochs, before, rise, taken, position`` of every row.

    A source is taken in whole passes; of the last pass the documents up to the rest of
    the target are taken, the one that holds its end if half of it fits. ``epochs`` are
    the passes that hold the document, ``position`` is its first place in the mix, in 0
    to 1; a later pass stands ``source_size / target`` further along the demand.
    """
    text = text_or_empty(docs, text_column)
    picked = docs.select(docs[id_column].alias("doc_id"), text.alias("text"), docs[source_column].cast("string").alias("source"))
    rows = stage(picked.select(
        "doc_id", row_key(F.col("text")).alias("row_key"), word_count(F.col("text")).alias("size"), "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("part"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("order"),
    ))
    sources = rows.groupBy("part", "source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sources, weights, max_epochs).select("part", "source_size", "rank", "target"))
    # As many slots as rows in a slot: both steps of the running sum stay small.
    slots = F.lit(math.isqrt(rows.count()) + 1)
    slotted = rows.withColumn("slot", F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * slots, 32))
    within = Window.partitionBy("part", "slot").orderBy("order", "doc_id", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slotted.groupBy("part", "slot").agg(F.sum("size").alias("slot_size")).withColumn("start", F.coalesce(F.sum("slot_size").over(over), F.lit(0)))
    known = stage(starts.drop("slot_size").join(targets, "part"))
    at = slotted.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(known, ["part", "slot"])
    at = at.withColumn("before", F.col("start") + F.col("inside"))
    passes = F.floor(F.try_divide("target", F.col("source_size").cast("double")))
    rest = F.col("target") - passes * F.col("source_size")
    again = (F.col("before") + F.col("size") / F.lit(2.0) <= rest).cast("long")
    epochs = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.least(passes + again, F.lit(max_epochs))).cast("long")
    rises = F.get(F.array(*[F.lit(float(r)) for r in rise]), F.pmod("rank", F.lit(len(rise))).cast("int"))
    return at.select(
        "doc_id", "row_key", "size", "source", "source_size", "target", epochs.alias("epochs"), "before", rises.alias("rise"),
    ).withColumn("taken", F.col("epochs") * F.col("size")).withColumn("position", place(F.lit(0)))


def place(epoch: Column) -> Column:
    """Position of a document's words of one pass, from the columns of ``mixture``."""
    reached = F.col("before") + epoch * F.col("source_size")
    share = F.coalesce(F.least(F.lit(1.0), F.try_divide(reached.cast("double"), "target")), F.lit(0.0))
    return position(share, F.col("rise"))


def mix(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The rows of ``docs`` in the order of the mix, each as often as the mix takes it, columns unchanged.

    Of rows that agree in id and text each stands there as often as its own passes say.
    """
    plan = mixture(docs, id_column=id_column, text_column=text_column, source_column=source_column).where("epochs > 0")
    passes = plan.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int") - 1)))
    turns = passes.select("doc_id", "row_key", place(F.col("epoch")).alias("at"))
    rows = packed(docs, id_column, text_column)
    if not rows.groupBy("id", "key").count().where("count > 1").isEmpty():
        # Every copy has its own turns; one stored text serves them all.
        rows = rows.dropDuplicates(["id", "key"])
    right = turns.select(F.col("doc_id").alias("want_id"), F.col("row_key").alias("want_key"), "at")
    placed = rows.join(right, same_row())
    return placed.repartitionByRange("at", F.xxhash64("id")).sortWithinPartitions("at", "id").select("packed.*")
