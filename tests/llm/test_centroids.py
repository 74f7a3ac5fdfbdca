"""Clustering over zone maps: curve, bounds, and whole results against brute force."""

import hashlib
import itertools
import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from llm import centroids

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=40, rounds=5, d=64):
    """(vec_id, cluster, distance) of the kept vectors in sorted order, and final centroids."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == d and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [max(-(2**27), min(2**27, math.floor(256 * c))) if abs(256 * c) != math.inf else int(math.copysign(2**27, c)) for c in x]))
    def mark(row):
        return (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])
    cs = [v for _, v in sorted(kept, key=mark)[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = [[] for _ in cs]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        cs = [[sum(col) // len(vs) for col in zip(*vs)] if vs else c for vs, c in zip(own, cs)]
    found = [(i, *nearest(v)) for i, v in kept]
    return sorted(((i, c, dist) for i, dist, c in found), key=str), cs


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 2), (4, 2), (6, 1)])
def test_curve_visits_neighbours(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    key = centroids.hilbert_index(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_bounds_keep_the_nearest():
    rng = np.random.default_rng(0)
    pruned = 0
    for _ in range(200):
        centre = rng.integers(-500, 500, 8)
        x = centre + rng.integers(-60, 60, (30, 8))
        cs = rng.integers(-600, 600, (12, 8))
        able = centroids.candidates(x.min(0), x.max(0), cs)
        pruned += 12 - len(able)
        number, distance = centroids.nearest_centroids(x, cs, able)
        d = ((x[:, None] - cs) ** 2).sum(2)
        assert (number == d.argmin(1)).all() and (distance == d.min(1)).all()
    assert pruned > 1200


def test_great_numbers_stay_exact():
    x = np.array([[1 << 27, -(1 << 27)], [(1 << 27) - 1, 5]])
    cs = np.array([[-(1 << 27), 1 << 27], [1 << 27, -(1 << 27) + 1]])
    number, distance = centroids.nearest_centroids(x, cs, np.arange(2))
    assert number.tolist() == [1, 1] and distance.tolist() == [1, 1 + (-(1 << 27) + 1 - 5) ** 2]


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_query_against_brute_force_and_sql(spark, sf_dir):
    got = contract.queries()["op11_hilbert_zones"](spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, cs = brute(rows)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    total = sum(d for _, _, d in want)
    for r in got:
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    sql = con.execute(contract.oracle_sql()["op11_hilbert_zones"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(sql)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 64)).round(3)
    rows = [(i, x[i % 150].tolist(), 0) for i in range(300)]
    rows += [(7, x[0].tolist(), 0), (None, x[3].tolist(), 0), (None, [1e30] * 64, 0), (2**53 + 1, [-3e38] * 64, 0), (2**53 + 3, [0.0] * 64, 0)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [1.0] * 63, 0), (1003, [float("nan")] + [0.0] * 63, 0), (1004, [None] + [0.0] * 63, 0), (1005, [float("inf")] * 64, 0)]
    rows += [(2000 + i, x[5].tolist(), 0) for i in range(600)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "label AS cluster", "label AS distance", "label AS `row`", "label AS v", "label AS `key`").repartition(5)
    found = centroids.cluster_report(table).collect()
    floats = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v, _ in rows]
    want, _ = brute(floats)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=str) == want


def test_few_and_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster_report(none).collect() == []
    assert centroids.cluster_report(none).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    few = spark.createDataFrame([(i, [float(i)] * 64, 0) for i in range(3)], SCHEMA)
    got = centroids.cluster_report(few).collect()
    assert {r.cluster for r in got} == {0, 1, 2} and {r.inertia for r in got} == {0}
