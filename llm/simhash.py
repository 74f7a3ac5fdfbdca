"""SimHash near-duplicates: segment popcounts as an embedding, a grid join, exact checks.

A fingerprint's 32 two-bit segments have popcounts 0, 1 or 2. The Manhattan distance of two
popcount vectors is a lower bound of the Hamming distance. Vectors at distance 3 or less
agree on at least three of six groups of coordinates, so they meet in one of twenty grids
whose cells are the popcounts of three groups (24 bits of entropy). Cells hold few
fingerprints; inside a cell exact distances decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from bankmart.sources import stage
from llm.common import free_name, map_texts

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Bits of each group of two-bit segments: six runs of whole segments.
GROUPS = [(0, 12), (12, 24), (24, 34), (34, 44), (44, 54), (54, 64)]
#: Groups that must agree: of six, at most three can hold the differences.
AGREE = len(GROUPS) - DISTANCE
#: Fingerprints of a cell compared directly; larger cells are split by sixteen-bit blocks.
DIRECT = 3000


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the text's three-word shingles with A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_digest
    packed = b"".join([digest(s, SEED) for s in shingles])
    n = len(packed) // 8
    ones = np.zeros(64, np.int64)
    table = np.frombuffer(packed, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(table[at : at + 4096], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones > n / 2).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """Columns ``keep`` and the signed 64-bit fingerprint of each whole text."""

    def compute():
        return lambda texts: [pa.array([fingerprint(t) for t in texts], pa.int64())]

    return map_texts(docs, text, [StructField(name, LongType())], compute, keep or ["doc_id"])


def _popcounts(fp: Column) -> Column:
    """Each two-bit segment replaced by its number of ones (0 to 2)."""
    fives = F.lit(0x5555555555555555)
    even, odd = fp.bitwiseAND(fives), F.shiftrightunsigned(fp, 1).bitwiseAND(fives)
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def grid_cells(prints: DataFrame) -> DataFrame:
    """Twenty rows per fingerprint: grid number, cell, fp."""
    def bits(low: int, high: int) -> int:
        mask = ((1 << (high - low)) - 1) << low
        return mask - (1 << 64) if mask >> 63 else mask

    counts = _popcounts(F.col("fp"))
    cells = []
    for grid, chosen in enumerate(combinations(range(len(GROUPS)), AGREE)):
        mask = 0
        for g in chosen:
            mask |= bits(*GROUPS[g]) & ((1 << 64) - 1)
        mask = mask - (1 << 64) if mask >> 63 else mask
        cells.append(F.struct(F.lit(grid).cast("byte").alias("grid"), F.col("counts").bitwiseAND(F.lit(mask)).alias("cell")))
    return prints.withColumn("counts", counts).select(F.explode(F.array(*cells)).alias("c"), "fp").select("c.grid", "c.cell", "fp")


def _forest(values: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what lies within ``DISTANCE``, directly or over others: a spanning
    forest, so copies are never expanded into all pairs."""
    links: list[tuple[int, int]] = []
    rest = values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= DISTANCE
            if near.any():
                found = rest[near]
                links += [(int(x), int(y)) for y in found]
                queue += list(found)
                rest = rest[~near]
    return links


def cell_links(values: np.ndarray) -> list[tuple[int, int]]:
    """Links of one cell. In a large one fingerprints meet by equal sixteen-bit blocks first:
    three differences leave one of four blocks alike."""
    values = np.unique(values.view(np.uint64))
    if len(values) <= DIRECT:
        return _forest(values)
    links: list[tuple[int, int]] = []
    for shift in range(0, 64, 16):
        block = (values >> np.uint64(shift)) & np.uint64(0xFFFF)
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        for part in np.split(values[order], cuts):
            links += _forest(part)
    return links


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) with a < b of distinct fingerprints ``fp``, enough to connect each component.

    A cell's fingerprints come to one task: eight bytes each, no rows of documents, and copies
    of a text count once. A cell with one fingerprint needs no task at all.
    """
    cells = grid_cells(prints).groupBy("grid", "cell").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for k in range(batch.num_rows):
                links += cell_links(batch.column(0)[k].values.to_numpy().astype(np.int64))
            if links:
                ends = np.array(links, np.uint64).view(np.int64)
                low, high = ends.min(1), ends.max(1)
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

    return cells.select("fps").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, by large-star and small-star rounds.

    Each round is two joins on aggregated minima and is written, so a lost executor repeats
    one round at most; the number of rounds grows with the logarithm of the component size.
    """
    def star(both: DataFrame, only_larger: bool) -> DataFrame:
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = both.join(low, "u")
        if only_larger:
            return met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        out = met.select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.where("a <> b").distinct()

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stage(links, "simhash-links")
    before = mark(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stage(star(both, True).where("a <> b").distinct(), "simhash-large-star")
        edges = stage(star(large.select(F.col("b").alias("u"), F.col("a").alias("v")), False), "simhash-small-star")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def rooted(prints: DataFrame, least: Column) -> DataFrame:
    """fp, root, first: each distinct fingerprint ``fp``, the smallest one that links lead to, and the least ``least`` of its rows."""
    distinct = stage(prints.groupBy("fp").agg(F.min(least).alias("first")), "simhash-distinct")
    roots = components(near_links(distinct.select("fp")))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every document.

    Fingerprints link at ``DISTANCE`` or fewer differing bits; component_id is the smallest
    doc_id that links lead to. Null and wordless texts have fingerprint zero and are linked
    like any other. A null doc_id never names a component unless all its ids are null.
    Repeated rows share a fingerprint; an empty table gives no rows; other columns are not read.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text")), "simhash-fingerprints")
    named = rooted(prints, F.col("doc_id"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(stage(of_print, "simhash-components"), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicate_filter(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the one of the smallest doc_id.

    Rows count one by one: of equal ids the first written row stays, and a null id comes after
    all others, so every component keeps exactly one row.
    """
    row = free_name(docs, "_row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-documents")
    prints = stage(fingerprints(numbered.select("doc_id", "text", row), keep=["doc_id", row]), "simhash-fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    stays = rooted(prints, order).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    kept = numbered.join(stage(stays, "simhash-kept"), row, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
