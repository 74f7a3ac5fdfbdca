"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` equal cells. Virtual nodes stand on some of them; a cell belongs
to the next virtual node clockwise. A shard holds at most its share of all bytes plus
``EXCESS``; cells that overflow it go on clockwise to the next node whose shard has room. So
sizes are near equal whatever the keys, and a change moves little.

A row's place is the hash of its text, so equal texts lie together. A cell over a small part
of a shard is cut into pieces by a hash of the id and the written row number: a text that holds
a third of all rows spreads over the following nodes, even if all these rows are alike. Placing
works on cell totals (bounded in number), never on rows.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankmart.sources import stage

CELLS = 1 << 14
VIRTUAL = 64
#: Bytes of a shard over its equal share, as a part of it.
EXCESS = 0.0005
#: Pieces that a shard consists of at least: a cell heavier than such a piece is cut.
PIECES = 1024


def ring(shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in clockwise order; the same nodes for any count."""
    import xxhash

    nodes = {}
    for shard in range(shards):
        for v in range(virtual):
            cell = xxhash.xxh64_intdigest(f"node {shard} {v}") % cells
            while cell in nodes:
                cell = (cell + 1) % cells
            nodes[cell] = shard
    return sorted(nodes.items())


def place(pieces: list[tuple[int, int, int]], shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> dict[tuple[int, int], int]:
    """Shard of each (cell, piece) from (cell, piece, bytes), clockwise from its own node.

    A shard is full at its equal share plus ``EXCESS``; should a piece fit nowhere, it goes to
    the least full shard.
    """
    nodes = ring(shards, virtual, cells)
    starts = [c for c, _ in nodes]
    total = sum(b for _, _, b in pieces)
    most = total / shards * (1 + EXCESS)
    load = [0] * shards
    out = {}
    for cell, piece, size in sorted(pieces):
        at = bisect_left(starts, cell)
        seen: set[int] = set()
        for k in range(len(nodes)):
            shard = nodes[(at + k) % len(nodes)][1]
            if shard in seen:
                continue
            seen.add(shard)
            if load[shard] + size <= most:
                break
            if len(seen) == shards:
                shard = min(range(shards), key=lambda s: (load[s], s))
                break
        load[shard] += size
        out[cell, piece] = shard
    return out


def _cell() -> Column:
    return F.pmod(F.xxhash64(F.lit("cell"), F.col("_text")), F.lit(CELLS)).cast("int")


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; slots are gapless from 0 in a shard.

    Size is the text's UTF-8 bytes plus 1 (null counts as empty, and its crc32 is that of the
    empty text). Equal texts share a shard unless they overflow it. Rows alike in id and text
    may be numbered in either order, and are parted where they are too heavy; null ids are placed
    like any other; very long texts count whole; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    rows = text.select(
        "doc_id", (F.octet_length("_text") + 1).cast("long").alias("size"), F.crc32(F.col("_text").cast("binary")).alias("text_crc32"),
        _cell().alias("cell"), F.xxhash64(F.lit("piece"), "doc_id", F.xxhash64("_text")).alias("mark"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "sharding-rows")
    # Bounded: one row per cell.
    heavy = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    if not heavy:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    all_bytes, all_rows = sum(r.bytes for r in heavy), sum(r.n for r in heavy)
    share = [max(r.bytes * PIECES * shards / all_bytes, r.n * PIECES * shards / all_rows) for r in heavy]
    cuts = [(r.cell, max(1, int(-(-s // 1)))) for r, s in zip(heavy, share)]
    cut = spark.createDataFrame(cuts, "cell int, pieces int")
    # At most one row per cell: a bounded broadcast.
    cut_rows = rows.join(F.broadcast(cut), "cell").withColumn("piece", F.pmod(F.xxhash64("mark", "row"), F.col("pieces")).cast("int"))
    # Bounded: cells and twice PIECES * shards pieces.
    totals = cut_rows.groupBy("cell", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    where = place([(r.cell, r.piece, r.bytes) for r in totals], shards)
    first, placed = [0] * shards, []
    for r in sorted(totals, key=lambda r: (r.cell, r.piece)):
        shard = where[r.cell, r.piece]
        placed.append((r.cell, r.piece, shard, first[shard]))
        first[shard] += r.n
    plan = spark.createDataFrame(placed, "cell int, piece int, shard int, before long")
    order = Window.partitionBy("cell", "piece").orderBy("mark", "doc_id", "row")
    numbered = cut_rows.withColumn("_place", F.row_number().over(order) - 1)
    out = numbered.join(F.broadcast(plan), ["cell", "piece"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("_place")).cast("long").alias("slot"))


def shard_report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``assign`` under the law `bytes`: sizes near equal."""
    return assign(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
