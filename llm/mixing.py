"""Mixing sources to target weights: a low-discrepancy schedule of equal-token blocks.

Slot i of the mix has the golden-ratio point frac(i * phi), which falls into a source's part of
the cumulative weights. A source's slots, ranked, take the blocks of its shuffled documents in
turn, over and over, until its target is met. Built-in SQL functions only.

Prefix sums run in two levels, over range partitions and within one, so that a source, or an id,
with a third of all rows or of all slots never lies in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankmart.sources import stage
from llm.common import free_name, trimmed, word_array

#: Words of a block, documents of a range partition, slots of a chunk.
BLOCK, BUCKET, CHUNK = 256, 10_000, 4096
MOST_REPEATS = 3
#: Golden ratio conjugate as a fraction of 2**32, so that points are exact integers.
GOLDEN, UNIT = 2654435769, 1 << 32
#: Slots in excess of the targets' blocks: sources that lag by a few slots mostly finish within them.
SPARE = 1.02


def source_targets(rows: DataFrame) -> DataFrame:
    """source, source_size, weight, target from rows with ``source`` and ``size``.

    Sources by code point, null last, weigh 1, 2, 3 and so on again. A target is the weight's
    part of all sizes, at most ``MOST_REPEATS`` times the source's size; what that cuts off is shared again by weight.
    That fixed point is a water level: the sources with the least room per weight are full.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    sizes = sizes.withColumn("weight", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("long"))
    room = F.col("source_size") * MOST_REPEATS / F.col("weight")
    by_room = Window.orderBy(room, F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    sizes = sizes.select(
        "source", "source_size", "weight", F.sum("source_size").over(every).alias("_all"),
        F.coalesce(F.sum(F.col("source_size") * MOST_REPEATS).over(before), F.lit(0)).alias("_full"), F.sum("weight").over(onward).alias("_rest"),
    )
    # The level if this source and all with more room are not full. Filling a source raises it as
    # long as that source is over its room, and lowers it after: the largest is the right one.
    level = (F.col("_all") - F.col("_full")) / F.col("_rest")
    found = F.max(level).over(every)
    target = F.least(F.col("source_size") * F.lit(float(MOST_REPEATS)), F.col("weight") * F.coalesce(found, F.lit(0.0)))
    return sizes.select("source", "source_size", "weight", F.round(target, 6).alias("target"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size and a row number of every document, written once."""
    source = F.col("source").cast("string") if "source" in {c.lower() for c in docs.columns} else F.lit(None).cast("string")
    words = F.size(word_array(trimmed(F.col(f"`{text}`")))).cast("long")
    return stage(docs.select("doc_id", source.alias("source"), words.alias("size"), F.monotonically_increasing_id().alias("row")), "mixing-rows")


def positions(rows: DataFrame, parts: int) -> DataFrame:
    """``start``: words before a document in its source's shuffled stream (order of md5(doc_id), size, row).

    Rows are put in that order by range partitions and written with their place. The row number
    comes last in the order, so a source, an id or null ids with most rows are cut like any others.
    """
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    order = [F.col(c) for c in ("source", "mark", "size", "row")]
    ranged = rows.select("*", mark.alias("mark")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut = stage(ranged.withColumn("place", F.monotonically_increasing_id()), "mixing-order").withColumn("bucket", F.shiftright("place", 33))
    sums = cut.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("_before")), "mixing-buckets")
    inner = Window.partitionBy("source", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("_in", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    met = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    return met.select("doc_id", "source", "size", "row", (F.col("_before") + F.col("_in")).alias("start"))


def schedule(targets: DataFrame) -> DataFrame:
    """slot, source, block: which block of which source each slot of the mix takes.

    A source gets exactly the blocks of its target; slots that fall on a source that is done
    are left out, so slot numbers rise but are not gapless. Small sources can lag behind all
    points of the mix: blocks that no point has met take slots of their own after the last.
    """
    spark = targets.sparkSession
    # Exact bounds in points of 2**32; one row per source.
    so_far = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(0))
    part = F.round(F.sum("target").over(so_far) / F.sum("target").over(every) * UNIT).cast("long")
    bounds = targets.where("target > 0").select("source", "target", part.alias("high"), F.ceil(F.col("target") / BLOCK).alias("blocks"))
    bounds = bounds.withColumn("low", F.lag("high", 1, 0).over(Window.orderBy("high", F.col("source").isNull(), F.encode("source", "UTF-8"))))
    bounds = stage(bounds, "mixing-bounds")
    total = bounds.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count("*")).first()
    length = int(total[0] * SPARE) + 64 * total[1] if total[0] else 0
    slots = spark.range(length).withColumnRenamed("id", "slot")
    points = slots.withColumn("point", F.pmod(F.col("slot") % UNIT * GOLDEN, F.lit(UNIT)))
    # Sources are stretched over cells of the unit interval they cover, so that a slot meets its source by an equal cell.
    grid = 4096
    wide = UNIT // grid
    cells = bounds.select("*", F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor(F.greatest(F.col("high") - 1, F.col("low")) / wide))).alias("cell"))
    met = points.withColumn("cell", F.floor(F.col("point") / wide)).join(cells, "cell").where("point >= low AND point < high")
    met = met.select("slot", "source", "blocks", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = stage(met.groupBy("source", "chunk").agg(F.count("*").alias("n")), "mixing-chunks")
    reached = counts.groupBy(F.col("source").alias("_s")).agg(F.sum("n").alias("_n"))
    short = bounds.join(reached, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    short = short.where("_n < blocks").withColumn("lacks", F.col("blocks") - F.col("_n"))
    in_turn = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    short = short.withColumn("_first", F.coalesce(F.sum("lacks").over(in_turn), F.lit(0)) + length)
    late = short.select("source", F.posexplode(F.sequence(F.col("_n"), F.col("blocks") - 1)).alias("_k", "block"), "_first")
    late = late.select((F.col("_first") + F.col("_k")).alias("slot"), "source", "block")
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("_s"), F.col("chunk").alias("_c"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = met.withColumn("_in", F.row_number().over(own) - 1)
    both = ranked.join(counts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c")))
    on_time = both.withColumn("block", F.col("_before") + F.col("_in")).where(F.col("block") < F.col("blocks")).select("slot", "source", "block")
    return on_time.unionByName(late)


def mix(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """slot, source, block, doc_id, row, pass, start, length: which words of which document each slot holds.

    A source's stream repeats from its beginning; its last block ends at the target. ``start`` is
    the first word taken of the document.
    """
    count = rows.agg(F.count("*")).first()[0]
    placed = positions(rows, max(1, -(-count // BUCKET)))
    goal = targets.select(F.col("source").alias("_s"), "source_size", F.floor("target").cast("long").alias("goal"))
    spread = placed.where("size > 0").join(goal, F.col("source").eqNullSafe(F.col("_s")))
    # A document's words at each pass over the stream, cut at the target, then by block.
    passes = F.sequence(F.lit(0), F.least(F.ceil(F.col("goal") / F.col("source_size")), F.lit(MOST_REPEATS)).cast("int") - 1)
    runs = spread.where("goal > 0").select("*", F.explode(passes).alias("pass")).withColumn("at", F.col("pass") * F.col("source_size") + F.col("start"))
    runs = runs.where("at < goal").withColumn("end", F.least(F.col("at") + F.col("size"), F.col("goal")))
    parts = runs.select("*", F.explode(F.sequence(F.floor(F.col("at") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("block"))
    low, high = F.greatest(F.col("at"), F.col("block") * BLOCK), F.least(F.col("end"), (F.col("block") + 1) * BLOCK)
    parts = parts.select("source", "block", "doc_id", "row", "pass", (low - F.col("at")).alias("start"), (high - low).alias("length"))
    slots = schedule(targets).select("slot", F.col("source").alias("_s"), F.col("block").alias("_k"))
    met = parts.join(slots, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_k")))
    return met.select("slot", "source", "block", "doc_id", "row", "pass", "start", "length")


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    rows = measured(docs, text)
    targets = stage(source_targets(rows), "mixing-targets")
    taken = mix(rows, targets).groupBy("row").agg(F.sum("length").alias("taken"), F.min("slot").alias("first_slot"))
    goal = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = rows.join(taken, "row", "left").join(goal, F.col("source").eqNullSafe(F.col("_s")))
    return out.select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot (in the schedule) of every document.

    Null, empty and blank texts have size 0 and are never taken (their slot is null); a null source
    is a source like any other, and comes last. Equal or null ids are shuffled by size, then by row.
    Very long texts are cut into blocks like any others. Repeated rows are rows of their own; an
    empty table gives no rows; other columns are not read.
    """
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def mixing_filter(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix holds them and in its order, with all their columns.

    A document counts whole: one of which at least half a pass is taken enters for that pass,
    at the slot where the pass begins. Wordless documents have nothing to take and leave; null and
    repeated ids are told apart by row; an empty table gives no rows; columns of any name pass through.
    """
    row, slot = free_name(docs, "_row"), free_name(docs, "_slot")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    numbered = stage(numbered, "mixing-documents", compression="zstd")
    rows = numbered.select("doc_id", F.col("source").cast("string").alias("source"), F.size(word_array(trimmed(F.col("text")))).cast("long").alias("size"), F.col(row).alias("row"))
    rows = stage(rows, "mixing-rows")
    targets = stage(source_targets(rows), "mixing-targets")
    passes = mix(rows, targets).groupBy("row", "pass").agg(F.sum("length").alias("n"), F.min("slot").alias("slot"))
    # At most MOST_REPEATS passes of a row.
    taken = passes.groupBy("row").agg(F.sum("n").alias("taken"), F.sort_array(F.collect_list("slot")).alias("slots")).join(rows.select("row", "size"), "row")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    entered = taken.select(F.col("row").alias(row), F.explode(F.slice("slots", 1, times)).alias(slot))
    return numbered.join(entered, row).orderBy(slot, row).select(*[F.col(f"`{c}`") for c in docs.columns])
