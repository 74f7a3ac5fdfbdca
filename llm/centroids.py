"""Centroid clustering over zone maps along a space-filling curve.

Vectors are put in order of their Hilbert index over the components that vary most and cut into
blocks with the least and greatest value of every component. Distances from a centroid to the
nearest and farthest corner of a block's box bound those to all its vectors: centroids farther
than another one's farthest corner are out, and the rest are compared with the block's vectors
exactly, in whole numbers.

A round sends the centroids to the blocks and brings back sums per centroid, so nothing but
these few numbers moves between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from bankmart.sources import stage

DIMENSION, CENTROIDS, ROUNDS, SALT = 64, 40, 5, "2"
#: Whole numbers for each unit of a component, and the greatest of them: squared distances fit 64 bits.
STEPS, MOST = 256, 1 << 27
#: Components that the curve runs through, and bits of each.
AXES, BITS = 9, 7
#: Vectors of a block.
ROWS = 256


def kept_vectors(vectors: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """vec_id, whole numbers ``v``, and a row number of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    own = vectors.select("vec_id", x.alias("x")).where(F.size("x") == dimension)
    own = own.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c * STEPS, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int"))
    return own.select("vec_id", whole.alias("v"), F.monotonically_increasing_id().alias("row"))


def first_centroids(kept: DataFrame, k: int, salt: str = SALT) -> list[list[int]]:
    """The ``k`` vectors of smallest sha256 of salt and vec_id; null ids come last, ties by vector."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    found = kept.select(mark.alias("mark"), "v").orderBy(F.asc_nulls_last("mark"), "v").limit(k)
    return [r.v for r in found.collect()]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def spreads(kept: DataFrame, dimension: int) -> np.ndarray:
    """Per component: variance, least, greatest. A row per task and component is shuffled."""
    names = ["at", "n", "s", "q", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(dimension), np.zeros(dimension)
        low, high = np.full(dimension, np.inf), np.full(dimension, -np.inf)
        for batch in batches:
            x = _matrix(batch.column(0), dimension).astype(np.float64)
            if len(x):
                n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            parts = [np.arange(dimension), np.full(dimension, n), s, q, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=names)

    schema = StructType([StructField(c, LongType() if c in ("at", "n") else DoubleType()) for c in names])
    sums = kept.select("v").mapInArrow(run, schema).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.zeros((dimension, 3))
    for r in sums.collect():
        out[r["at"]] = r["q"] / r["n"] - (r["s"] / r["n"]) ** 2, r["low"], r["high"]
    return out


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of non-negative cell numbers under 2 ** bits.

    Cells are undone from Gray codes, highest bit first: at each bit the axes turn as the curve
    turns in the cube that the bit chooses. Rows times bits are at most 63.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        below = (np.int64(1) << bit) - 1
        for a in range(axes):
            flips = (x[a] >> bit) & 1 == 1
            swap = np.where(flips, 0, (x[0] ^ x[a]) & below)
            x[0] = np.where(flips, x[0] ^ below, x[0] ^ swap)
            x[a] ^= swap
    for a in range(1, axes):
        x[a] ^= x[a - 1]
    turned = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> bit) & 1 == 1, (np.int64(1) << bit) - 1, 0)
    x ^= turned
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for a in range(axes):
            key = (key << 1) | ((x[a] >> bit) & 1)
    return key


def zone_maps(kept: DataFrame, dimension: int) -> DataFrame:
    """Blocks of neighbours on the curve: n, ids, data (whole numbers, little-endian), low, high.

    Range partitions part equal places by row number, so any number of equal vectors is split.
    """
    spread = spreads(kept, dimension)
    axes = np.sort(np.argsort(-spread[:, 0], kind="stable")[: min(AXES, dimension)])
    low, wide = spread[axes, 1], np.maximum(spread[axes, 2] - spread[axes, 1], 1)
    id_type = kept.schema["vec_id"].dataType

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dimension)
            cells = np.minimum((x[:, axes] - low) / wide * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
            key = pa.array(hilbert_index(cells, BITS), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, key], names=["vec_id", "v", "row", "key"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n": [], "data": [], "low": [], "high": []}
            ids = []
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                x = _matrix(rows.column(1), dimension).astype("<i4")
                ids.append(rows.column(0))
                for name, value in zip(out, (len(x), x.tobytes(), x.min(0).tobytes(), x.max(0).tobytes())):
                    out[name].append(value)
            if ids:
                ends = np.concatenate([[0], np.cumsum(out["n"])])
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(ids))
                yield pa.RecordBatch.from_arrays([pa.array(out["n"], pa.int32()), listed, *[pa.array(out[c], pa.binary()) for c in ("data", "low", "high")]], names=["n", "ids", "data", "low", "high"])

    along = kept.mapInArrow(keyed, StructType([*kept.schema.fields, StructField("key", LongType())]))
    ordered = along.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("vec_id", "v")
    kinds = kept.sparkSession.createDataFrame([], StructType([StructField("vec_id", id_type)])).selectExpr("array(vec_id) AS ids").schema["ids"].dataType
    schema = StructType([StructField("n", IntegerType()), StructField("ids", kinds), *[StructField(c, BinaryType()) for c in ("data", "low", "high")]])
    return ordered.mapInArrow(blocks, schema)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to some point of the box, rising."""
    short = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((short * short).sum(1) <= (far * far).sum(1).min())


def nearest_centroids(x: np.ndarray, centroids: np.ndarray, able: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest of the ``able`` centroids; ties to the smaller."""
    own = centroids[able]
    if max(np.abs(x).max(), np.abs(own).max()) < 1 << 21:
        # Every product and sum is a whole number under 2 ** 53: doubles are exact.
        f, c = x.astype(np.float64), own.astype(np.float64)
        d = ((f * f).sum(1)[:, None] - 2 * (f @ c.T) + (c * c).sum(1)).astype(np.int64)
    else:
        d = np.stack([((x - c) ** 2).sum(1) for c in own], axis=1)
    best = d.argmin(1)
    return able[best], d[np.arange(len(x)), best]


def _assigned(batch: pa.RecordBatch, dimension: int, centroids: np.ndarray):
    """Vectors, numbers and distances of each block of a batch with columns data, low, high."""
    for data, low, high in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("data", "low", "high")]):
        x = np.frombuffer(data, "<i4").reshape(-1, dimension).astype(np.int64)
        box = [np.frombuffer(b, "<i4").astype(np.int64) for b in (low, high)]
        yield x, *nearest_centroids(x, centroids, candidates(*box, centroids))


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; those without vectors stay."""
    k, dimension = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for x, number, _ in _assigned(batch, dimension, centroids):
                for c in np.unique(number):
                    own = x[number == c]
                    sums[c] += own.sum(0)
                    counts[c] += len(own)
        used = np.flatnonzero(counts)
        if len(used):
            parts = [np.repeat(used, dimension), np.tile(np.arange(dimension), len(used)), np.repeat(counts[used], dimension), sums[used].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["c", "at", "n", "s"])

    parts = blocks.select("data", "low", "high").mapInArrow(run, "c long, at long, n long, s long")
    new = centroids.copy()
    # Bounded: one row per centroid and component.
    for r in parts.groupBy("c", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        new[r["c"], r["at"]] = r["s"] // r["n"]
    return new


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance (squared) of every vector kept, and the final centroids.

    Vectors that are null, of another length, or hold null or non-finite components are left
    out. Components are taken in steps of 1/256; those beyond plus or minus 2 ** 19 count as
    that, so that squared distances fit. Repeated ids and null ids are vectors of their own (null
    ids start a centroid only if there are too few others). Ties go to the smaller centroid.
    With fewer than ``k`` vectors each is a centroid; an empty table gives no rows; other columns
    are not read.
    """
    spark = vectors.sparkSession
    kept = stage(kept_vectors(vectors, dimension), "centroid-vectors")
    centroids = np.array(first_centroids(kept, k, salt), np.int64).reshape(-1, dimension)
    schema = StructType([kept.schema["vec_id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    blocks = stage(zone_maps(kept, dimension), "centroid-blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_assigned(batch, dimension, centroids))
            if found:
                number, distance = (np.concatenate([f[i] for f in found]) for i in (1, 2))
                yield pa.RecordBatch.from_arrays([batch.column(0).flatten(), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return blocks.select("ids", "data", "low", "high").mapInArrow(run, schema), centroids


def cluster_report(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector kept.

    Cases as in ``cluster``; an inertia beyond 64 bits is null.
    """
    found, centroids = cluster(vectors)
    found = stage(found, "centroid-clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    total = sum(int(r.d) for r in sums)

    def fit(n: int) -> int | None:
        return n if n < 1 << 63 else None

    hashes = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = [(r.cluster, fit(int(r.d)), fit(total), hashes[r.cluster]) for r in sums]
    # At most one row per centroid: a bounded broadcast.
    about = found.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
