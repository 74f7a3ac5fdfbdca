"""Nearest neighbours by randomly rotated one-bit codes.

Each vector, less the mean of all, is padded, rotated by a random orthogonal matrix and kept as
its signs, its length and a correction scalar. Inner products with a query are estimated
from the packed bits; the error bound of each estimate decides which vectors are reranked by the
exact inner product in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from bankmart.sources import stage

#: Bits of a code for each dimension, and the seed of the rotation.
BITS_PER_DIMENSION, SEED = 4, 20
#: Width of the error bound in standard deviations of an estimate.
SIGMAS = 2.5
#: Vectors and queries of a block: each vector is copied once for so many queries, each query once for so many vectors.
ROWS, QUERIES = 32_768, 16_384
EVERY = 20
TOP = 20


def valid(vectors: DataFrame) -> DataFrame:
    """Rows with finite, nonzero vectors of the most frequent dimension (of two, the larger)."""
    own = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(finite).where(F.exists("v", lambda x: x != 0))
    sizes = own.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return own.where(F.size("v") == (sizes[0].d if sizes else 0))


def centre(vectors: DataFrame) -> np.ndarray:
    """Mean of the vectors, of one length; a row for each task and component is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                n, total = n + len(x), total + x.sum(0)
        if n:
            parts = [np.arange(len(total)), np.full(len(total), n), total]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["at", "n", "s"])

    sums = vectors.select("v").mapInArrow(run, "at long, n long, s double").groupBy("at")
    found = sums.agg((F.sum("s") / F.sum("n")).alias("x")).orderBy("at").collect()
    return np.array([r.x for r in found])


def rotation(dimension: int) -> np.ndarray:
    """The first ``dimension`` columns of a random orthogonal matrix of the code's length."""
    length = -(-dimension * BITS_PER_DIMENSION // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((length, length)))
    return (q * np.sign(np.diag(r)))[:, :dimension]


def encode(vectors: DataFrame, mean: np.ndarray) -> DataFrame:
    """vec_id, v, code (packed signs), radius and correction of each vector."""
    turn = rotation(len(mean))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.stack(frame["v"].to_numpy()) - mean
            radius = np.sqrt((x * x).sum(1))
            unit = (x / np.maximum(radius, 1e-300)[:, None]) @ turn.T
            correction = np.abs(unit).sum(1) / np.sqrt(len(turn))
            code = [row.tobytes() for row in np.packbits(unit > 0, axis=1)]
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "code": code, "radius": radius, "correction": np.maximum(correction, 1e-6)})

    return vectors.mapInPandas(run, "vec_id long, v array<double>, code binary, radius double, correction double")


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products row by row in one order of summation, so equal vectors score equally."""
    return (vectors * query).sum(1)


def search_block(rows: pd.DataFrame, queries: pd.DataFrame, mean: np.ndarray, turn: np.ndarray, k: int) -> pd.DataFrame:
    """The block's best ``k`` for each query.

    The best by estimate are scored exactly; that bar and the bounds choose all others that
    could still be better, which are then scored exactly too.
    """
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy())
    radius, correction = rows["radius"].to_numpy(), rows["correction"].to_numpy()
    length = len(turn)
    bits = np.unpackbits(np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1), axis=1)
    signs = (2.0 * bits[:, :length] - 1.0).astype(np.float32) / np.sqrt(length)
    scale = (radius / correction).astype(np.float32)
    spread = radius * np.sqrt(np.maximum(0.0, 1 - correction**2)) / correction / np.sqrt(max(1, length - 1)) * SIGMAS
    found = []
    for start in range(0, len(queries), 128):
        part = queries.iloc[start : start + 128]
        q = np.stack(part["v"].to_numpy())
        estimates = (signs @ (q @ turn.T).T.astype(np.float32)) * scale[:, None]
        norms, bases = np.sqrt((q * q).sum(1)), q @ mean
        for j, query in enumerate(part["vec_id"].to_numpy()):
            about = estimates[:, j] + bases[j]
            bound = about + spread * norms[j]
            others = ids != query
            bound[~others] = about[~others] = -np.inf
            n = min(k, int(others.sum()))
            if not n:
                continue
            first = np.argpartition(-about, n - 1)[:n]
            scores = _exact(vectors[first], q[j])
            more = np.flatnonzero(bound >= scores.min())
            more = np.setdiff1d(more, first, assume_unique=True)
            near = np.concatenate([first, more])
            scores = np.concatenate([scores, _exact(vectors[more], q[j])])
            best = np.lexsort((ids[near], -scores))[:n]
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids[near][best], "score": scores[best]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(vectors: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest by inner product.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows but those
    with the query's own id. Ties go to the smaller vec_id. Null ids and vectors that are null, zero,
    of another dimension, or with null or non-finite parts take no part; an empty table gives
    no rows. Of rows with one vec_id each is a candidate; repeated queries are searched once for
    each id (the row of the smallest vector). Columns of other names are not read.

    Codes and queries are cut into blocks by hash; each pair of blocks is a task of bounded size
    that hands on ``k`` rows for each query. A copy of the codes goes to each block of queries.
    """
    spark = vectors.sparkSession
    known = valid(vectors)
    mean = centre(known)
    if not len(mean):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    turn = rotation(len(mean))
    codes = stage(encode(known, mean), "ann-codes")
    n = codes.count()
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(-(-n // ROWS), min(many, -(-n // 256)))
    asked = codes.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    query_blocks = max(1, -(-n // (every * QUERIES)))
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id", "v"), F.lit(row_blocks)).cast("int")
    queries_of = F.pmod(F.xxhash64(F.lit("queries"), "vec_id"), F.lit(query_blocks)).cast("int")
    rows = codes.withColumn("rb", block).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = asked.withColumn("qb", queries_of).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_block(left, right, mean, turn, k)

    found = rows.groupBy("qb", "rb").cogroup(queries.groupBy("qb", "rb")).applyInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
