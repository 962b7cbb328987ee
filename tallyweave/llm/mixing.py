"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents, in a fixed shuffled order, are laid end to end and cut into blocks of equally many words, as
often over as its target asks. One slot per block: the slot's van der Corput point falls into the source whose interval
of cumulative weights holds it, and the slot's rank among those of its source names the block. So any run of consecutive slots
holds the sources close to their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, saved

WEIGHTS = (5, 2, 1)
#: Words in a block.
BLOCK = 256
#: Slots whose ranks are counted together.
RANKED = 1 << 16
#: Cells that the unit interval is cut into when points are matched with sources.
CELLS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, place, target): weights repeat over the sources in code point order, null last; no target
    exceeds ``limit`` times its source's size, and what is above is shared again by weight. One row a source, put in order in one task.

    The resharing ends at one level: sources in ascending order of limit over weight are at their limit up to the first
    whose limit the others' equal share per weight does not pass."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("place", place).withColumn("w", F.element_at(cycle, F.pmod("place", F.lit(len(weights))) + 1))
    per = per.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    whole, up = W.partitionBy(), W.orderBy(F.col("most") / F.col("w"), "place").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("most").over(up), F.lit(0.0))
    free = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(up), F.lit(0.0))
    per = per.withColumns({"left": left, "free": free, "at": F.row_number().over(W.orderBy(F.col("most") / F.col("w"), "place"))})
    level = F.min(F.when(F.col("most") * F.col("free") >= F.col("left") * F.col("w"), F.struct("at", "left", "free"))).over(whole)
    per = per.withColumn("level", level)
    target = F.when(F.col("at") < F.col("level.at"), F.col("most")).otherwise(F.col("w") * F.col("level.left") / F.col("level.free"))
    return per.select("source", "source_size", "place", F.least("most", target).alias("target"))


def schedule(slots: DataFrame, total: int) -> DataFrame:
    """(slot, place, rank): slots: (place, upto, n) with running numbers of slots per source. Slot i takes the point that mirrors
    the binary digits of i at the point, and with it a source; ranks count the slots of a source in order."""
    spark = slots.sparkSession
    digits = F.bin("slot")
    point = F.conv(F.reverse(digits), 2, 10).cast("long") / F.pow(F.lit(2.0), F.length(digits))
    points = spark.range(total).withColumnRenamed("id", "slot").withColumn("at", F.floor(point * F.lit(float(total))))
    cell = lambda c: F.floor(c * F.lit(CELLS) / F.lit(float(total)))
    spans = slots.filter("n > 0").select("place", (F.col("upto") - F.col("n")).alias("low"), F.col("upto").alias("high"))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
    hit = points.withColumn("cell", cell(F.col("at"))).join(spans, "cell").filter("at >= low AND at < high").select("slot", "place")
    hit = hit.withColumn("run", F.floor(F.col("slot") / RANKED))
    before = hit.groupBy("place", "run").agg(F.count("*").alias("n")).select("place", "run", (F.sum("n").over(W.partitionBy("place").orderBy("run")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("place", "run").orderBy("slot")) - 1
    return hit.withColumn("rank", rank).join(before, ["place", "run"]).select("slot", "place", (F.col("rank") + F.col("before")).alias("rank"))


def sizes_of(docs: DataFrame, id: str, text: str, source: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, source, size[, kept columns]); the size is the number of words of the whole text, 0 for null."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size.alias("size"), *keep)


def placed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the place of their source and the word at which they start in its shuffled stream. Sums run over
    slices of the order, so that no task holds a whole source."""
    rows = sizes.join(targets.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its"))).drop("its")
    rows = rows.withColumn("key", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = rows.withColumn("slice", F.substring("key", 1, 3))
    before = rows.groupBy("place", "slice").agg(F.sum("size").alias("n")).select("place", "slice", (F.sum("n").over(W.partitionBy("place").orderBy("slice")) - F.col("n")).alias("before"))
    inner = F.sum("size").over(W.partitionBy("place", "slice").orderBy("key", "size").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("inner", inner).join(before, ["place", "slice"]).withColumn("start", F.col("inner") + F.col("before")).drop("inner", "before", "key", "slice")


def quota(target: Column) -> Column:
    """Whole words that a source gives."""
    return F.floor(target + F.lit(0.5)).cast("long")


def mix(rows: DataFrame, block: int = BLOCK, limit: float = 2.0) -> DataFrame:
    """(place, start, pass, from_word, to_word, slot): which words of which row go into which slot.

    rows: from ``placed``. A row without words has no piece, and an empty table gives none. Passes count from 0; a
    source gives exactly the whole words nearest to its target, the last of its blocks being shorter. Blocks that the
    schedule's points do not reach (a source's points miss its number of blocks by a few) come after all others."""
    blocks = lambda c: F.ceil(quota(c) / F.lit(block)).cast("long")
    per = rows.groupBy("place").agg(F.first("target").alias("target")).withColumn("n", blocks(F.col("target")))
    per = saved(per.select("place", "n", F.sum("n").over(W.orderBy("place")).alias("upto")), "slots")
    total = per.agg(F.max("upto")).first()[0] or 0
    passes = rows.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max(1, math.ceil(limit)) - 1))))
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    passes = passes.withColumns({"begin": begin, "end": F.least(begin + F.col("size"), quota(F.col("target")))}).filter("begin < end")
    pieces = passes.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))))
    low, high = F.greatest("begin", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    pieces = pieces.select("place", "start", "pass", (low - F.col("begin")).alias("from_word"), (high - F.col("begin")).alias("to_word"), "block")
    plan = schedule(per, total).withColumnRenamed("rank", "block")
    return pieces.join(plan, ["place", "block"], "left").withColumn("slot", F.coalesce("slot", F.lit(total) + F.col("block"))).drop("block")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0, block: int = BLOCK, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: (id, source, size, source_size, target, taken, first_slot, kept columns).

    Null text has size 0, null source is a source of its own, the last; null and repeated ids are rows of their own.
    taken: words of the document in the mix, repeats counted, never above ``limit`` times its size rounded up.
    first_slot: the earliest slot that holds words of it, null if none does. Columns beside the named ones are left out
    unless ``keep`` names them."""
    sizes = saved(sizes_of(docs, id, text, source, keep), "sizes")
    rows = saved(placed(sizes, source_targets(sizes, weights, share, limit)), "placed")
    got = mix(rows, block, limit).groupBy("place", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"))
    got = got.withColumn("filled", F.lit(True))
    out = rows.withColumn("filled", F.col("size") > 0).join(got, ["place", "start", "filled"], "left")
    return out.select(F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", *keep)
