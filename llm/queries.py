"""The operators of this package as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import ann, centroids, chat, langid, license, mixing, packing, periodic, quality, secretscan, sharding, simhash, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_read(spark, sf_dir, "documents"))


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(_read(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_windows(turns, public_tokenizers.path("byte_bpe_50k.json")))


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_read(spark, sf_dir, "documents"))


def op6_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_language_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_read(spark, sf_dir, "documents"))


def op8_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_read(spark, sf_dir, "documents"))


def op9_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"))


def op10_golden_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(_read(spark, sf_dir, "documents"))


def op11_hilbert_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(_read(spark, sf_dir, "embeddings"))


def op12_char_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_report(_read(spark, sf_dir, "documents"))


def op13_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_mcd, op2_chat_windows, op3_toxicity_ftrl, op4_residual_packing, op5_license_compression,
        op6_simhash_popcount, op7_language_backoff, op8_bounded_ring, op9_one_bit_codes, op10_golden_schedule,
        op11_hilbert_zones, op12_char_cnn, op13_basic_factors,
    )
}



def _centroid_rounds(rounds: int = centroids.ROUNDS, k: int = centroids.CENTROIDS, d: int = centroids.DIMENSION) -> str:
    """Rounds of assignment and exact floors of means, written out one after the other."""
    distance = f"list_sum(list_transform(range(1, {d + 1}), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))"
    steps = [f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.STEPS} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
    FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {d}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('{centroids.SALT}:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v QUALIFY c < {k}
)"""]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT r, min({distance} * {k} + c.c) AS m FROM v, c{n} AS c GROUP BY r)")
        if n < rounds:
            steps.append(f"""p{n} AS (
    SELECT m % {k} AS c, i, CAST(floor(CAST(sum(v.v[i]) AS DOUBLE) / count(*)) AS HUGEINT) AS x FROM a{n} JOIN v USING (r), range(1, {d + 1}) AS t(i) GROUP BY ALL
), c{n + 1} AS (SELECT c, coalesce(list(x ORDER BY i) FILTER (x IS NOT NULL), any_value(c{n}.v)) AS v FROM c{n} LEFT JOIN p{n} USING (c) GROUP BY c)""")
    steps.append(f"f AS (SELECT vec_id, m % {k} AS c, m // {k} AS d FROM a{rounds} JOIN v USING (r))")
    return ", ".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM f JOIN c{rounds} USING (c)"""


# A source's stream is its documents by md5(doc_id); its first floor(target) words are taken,
# over up to three passes. A document's first slot is that of the block in which it begins.
ORACLES = {
    "op11_hilbert_zones": _centroid_rounds(),
    "op10_golden_schedule": r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM s
), l AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
    SELECT source, source_size, round(least(3.0 * source_size, weight * max(level) OVER ()), 6) AS target FROM l
), p AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM d
), b AS (
    SELECT source, CAST(ceil(target / 256) AS BIGINT) AS blocks,
        CAST(round(sum(target) OVER (ORDER BY source IS NULL, source) / sum(target) OVER () * 4294967296) AS BIGINT) AS high FROM t WHERE target > 0
), b2 AS (
    SELECT *, lag(high, 1, 0) OVER (ORDER BY high, source IS NULL, source) AS low FROM b
), n AS (
    SELECT CAST(floor(sum(blocks) * 1.02) AS BIGINT) + 64 * count(*) AS length FROM b
), m AS (
    SELECT i AS slot, source, blocks, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS block
    FROM n, range(length) AS r(i) JOIN b2 ON i * 2654435769 % 4294967296 >= low AND i * 2654435769 % 4294967296 < high
), e AS (
    SELECT source, blocks, coalesce(reached, 0) AS reached, length + coalesce(sum(blocks - coalesce(reached, 0)) OVER (
        ORDER BY source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS late
    FROM n, b LEFT JOIN (SELECT source AS s, least(count(*), any_value(blocks)) AS reached FROM m GROUP BY s) g ON source IS NOT DISTINCT FROM s
), u AS (
    SELECT slot, source, block FROM m WHERE block < blocks
    UNION ALL
    SELECT CAST(late + k AS BIGINT), source, reached + k FROM e, range(blocks - reached) AS r(k)
), x AS (
    SELECT doc_id, size, p.source AS source, begins, source_size, target, CAST(
        greatest(0, least(begins + size, floor(target)) - begins)
        + greatest(0, least(begins + size + source_size, floor(target)) - begins - source_size)
        + greatest(0, least(begins + size + 2 * source_size, floor(target)) - begins - 2 * source_size) AS BIGINT) AS taken
    FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, taken, CASE WHEN taken > 0 THEN slot END AS first_slot
FROM x LEFT JOIN u ON x.source IS NOT DISTINCT FROM u.source AND u.block = CAST(begins AS BIGINT) // 256
""",
}
