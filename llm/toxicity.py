"""Toxicity: logistic regression over hashed word n-grams, trained by FTRL-proximal.

Features are the set of hashed words, word stems, adjacent pairs and skip pairs of a text.
Each coordinate has its own learning rate, and L1 keeps most weights at exactly zero, so the
model is a short list of (bucket, weight) pairs: at most ``2 ** BITS``, in practice some
thousand, which is what is broadcast for scoring.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from llm.common import ROWS_AT_ONCE, bounded_labels, free_name, map_texts

BITS = 20
STEM = 4
#: Words between the two of a skip pair.
SKIPS = (1, 2)
#: Bound of the training sample, picked by a hash of doc_id among all labelled rows.
MAX_TRAIN_ROWS = 12_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 12.0, 0.0
#: Passes over the sample: as many as make so many steps, within these limits.
UPDATES, LEAST_PASSES, MOST_PASSES = 40_000, 3, 40
#: Words whose hashes a worker remembers.
CACHE = 150_000
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _Hashes(dict):
    """Token to its index in two arrays of hashes: the bare lower-case word, and its stem."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self):
        self.clear()
        self.word, self.stem = [], []
        self.arrays = (np.empty(0, np.uint64),) * 2

    def __missing__(self, token: str) -> int:
        bare = token.strip("\"'()[]{}<>.,;:!?*#$%&|_-=~^/\\").lower()
        self.word.append(xxhash.xxh64_intdigest(bare, seed=1))
        self.stem.append(xxhash.xxh64_intdigest(bare[:STEM], seed=2))
        self[token] = at = len(self.word) - 1
        return at

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > CACHE:
            self.forget()
        tokens = (text or "").split()
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(self.word) != len(self.arrays[0]):
            known = len(self.arrays[0])
            self.arrays = tuple(
                np.concatenate([old, np.array(new[known:], np.uint64)])
                for old, new in zip(self.arrays, (self.word, self.stem))
            )
        return self.arrays[0][at], self.arrays[1][at]


def features(hashes: _Hashes, text: str | None) -> list[np.ndarray]:
    """Buckets of all words, stems, adjacent pairs and skip pairs of the whole text."""
    word, stem = hashes.of(text)
    down = np.uint64(64 - BITS)
    out = [(word * _MIX[0]) >> down, (stem * _MIX[1]) >> down]
    for gap in (0, *SKIPS):
        if len(word) > gap + 1:
            out.append((word[: -gap - 1] * _MIX[2 + (gap > 0)] + word[gap + 1 :] * _MIX[gap % 2]) >> down)
    return out


def _train(rows, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over (buckets, label) rows; the last coordinate is the intercept."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.default_rng(seed)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        w[np.abs(z[i]) <= L1] = 0.0
        return w

    for _ in range(min(MOST_PASSES, max(LEAST_PASSES, -(-UPDATES // len(rows))))):
        for k in order.permutation(len(rows)):
            i, label = rows[k]
            w = weights(i)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / ALPHA * w
    w = weights(np.arange(size + 1))
    used = np.flatnonzero(w[:size])
    return used, w[used], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> list[tuple[int, float]]:
    """Sparse weights as (bucket, weight); bucket ``2 ** BITS`` is the intercept.

    ``labels`` has doc_id and toxic (0 or 1; null labels are skipped, of contradicting labels
    of one id the larger counts). At most ``MAX_TRAIN_ROWS`` labelled ids are learned from, one
    row of each (that of the smallest text hash), so the broadcast of the ids and the single training
    task are bounded whatever the input, and repeated rows crowd nothing out.
    Without labelled rows the model is empty and every score is 0.5.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    picked = bounded_labels(known, "doc_id", "_toxic", MAX_TRAIN_ROWS, MAX_TRAIN_ROWS)
    id_type, body = docs.schema["doc_id"].dataType, docs.select("doc_id", F.col(f"`{text}`").alias("_text"))
    train = body.join(F.broadcast(picked.select(F.col("doc_id").cast(id_type), "_toxic")), "doc_id")

    def featured(batches):
        """Of each picked id in a task the row of the smallest text hash, with its features."""
        hashes, found = _Hashes(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                for doc, body, toxic in zip(*(c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns)):
                    mark = xxhash.xxh64_intdigest(body or "") >> 1
                    if doc not in found or mark < found[doc][0]:
                        found[doc] = mark, toxic, np.unique(np.concatenate(features(hashes, body))).astype(np.int32)
        for doc, (mark, toxic, buckets) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([doc], id_arrow), pa.array([mark]), pa.array([toxic], pa.int32()), pa.array([buckets], pa.list_(pa.int32()))], names=["doc_id", "mark", "toxic", "buckets"])

    id_arrow = to_arrow_type(id_type)
    schema = StructType([StructField("doc_id", id_type), StructField("mark", LongType()), StructField("toxic", IntegerType()), StructField("buckets", ArrayType(IntegerType()))])
    rows = train.select("doc_id", "_text", "_toxic").mapInArrow(featured, schema)
    # One row of each picked id, whatever the number of its rows: no more than ids were picked.
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "buckets"), "mark").alias("row")).select("doc_id", "row.toxic", "row.buckets")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    intercept = 1 << BITS

    def learn(batches):
        sample = []
        for batch in batches:
            buckets, toxic = batch.column(2), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                own = buckets[i].values.to_numpy(zero_copy_only=False)
                sample.append((np.append(own, intercept).astype(np.int32), toxic[i]))
        if sample:
            used, w, bias = _train(sample)
            yield pa.RecordBatch.from_arrays([pa.array([*used, intercept], pa.int64()), pa.array([*w, bias], pa.float64())], names=["bucket", "weight"])

    model = rows.mapInArrow(learn, StructType([StructField("bucket", LongType()), StructField("weight", DoubleType())]))
    return [(r.bucket, r.weight) for r in model.collect()]


def score(docs: DataFrame, model: list[tuple[int, float]], text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Columns ``keep`` and the probability of the label 1 for each whole text."""
    table = np.zeros((1 << BITS) + 1)
    for bucket, weight in model:
        table[bucket] = weight
    used = np.flatnonzero(table[:-1])
    sent = docs.sparkSession.sparkContext.broadcast((used, table[used], table[-1]))

    def compute():
        at, weight, bias = sent.value
        w, hashes = np.zeros(1 << BITS, np.float64), _Hashes()
        w[at] = weight
        active = w != 0

        def run(texts):
            out = np.empty(len(texts))
            for k, t in enumerate(texts):
                hit = [f[active[f]] for f in features(hashes, t)]
                total = bias + w[np.unique(np.concatenate(hit))].sum()
                out[k] = 1 / (1 + math.exp(-max(-35.0, min(35.0, total))))
            return [pa.array(out)]

        return run

    return map_texts(docs, text, [StructField(name, DoubleType())], compute, keep or docs.columns)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fifth of ids."""
    return labels.where("pmod(crc32(CAST(doc_id AS STRING)), 5) <> 0")


def toxicity_filter(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Documents scored under ``limit``, with all their columns.

    Null and empty texts have no features, so their score is that of the intercept alone. Very
    long texts are read whole. Repeated rows get equal scores and stay or go together; an empty table gives no rows.
    """
    name = free_name(docs, "_toxicity")
    scored = score(docs, fit(docs, training_labels(labels)), name=name)
    return scored.where(F.col(name) < limit).drop(name)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. Cases as in ``toxicity_filter``.

    A null doc_id has no remainder: it is not held out, and no label belongs to it.
    """
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, training_labels(labels)), keep=["doc_id"])
    held = F.coalesce(F.expr("pmod(crc32(CAST(doc_id AS STRING)), 5) = 0"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
