"""Language identification: word first, then shorter and shorter character n-grams.

A known word scores its log frequency in each language. An unseen word is scored by the
longest character n-grams of it that are known, down to single characters.

Words and n-grams of the training documents are counted by Spark. All their scores lie in one
matrix, and the words of many texts are looked up and added up together.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from bankmart.sources import stage
from llm.common import bounded_labels, map_texts

#: Bounds of the training sample: documents per language and in all, picked by hash.
PER_LANGUAGE, MAX_TRAIN_ROWS = 1_500, 24_000
#: Sightings in the sample that make a word or n-gram known; words that are not known back off.
LEAST = 3
LENGTHS = (5, 4, 3, 2, 1)
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def grams(word: str, length: int) -> list[str]:
    """n-grams of a word with a blank at each end; single characters of the word itself."""
    padded = f" {word} " if length > 1 else word
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def _word_counts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """lang, word, n over the sample; counted per batch before the shuffle."""
    id_type = docs.schema["doc_id"].dataType
    own = picked.select(F.col("doc_id").cast(id_type)).distinct()
    rows = docs.where("lang IS NOT NULL").join(F.broadcast(own), "doc_id").select("lang", "text")

    def count(batches):
        for batch in batches:
            found = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[lang].update(words_of(text))
            for lang, words in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
                    names=["lang", "part", "n"],
                )

    return rows.mapInArrow(count, "lang string, part string, n long").groupBy("lang", "part").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """lang, length, part, n of the n-grams of all words, as often as these occur."""

    def cut(batches):
        for batch in batches:
            found = defaultdict(Counter)
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for length in LENGTHS:
                    own = found[lang, length]
                    for g in grams(word, length):
                        own[g] += n
            for (lang, length), own in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own)), pa.array([length] * len(own), pa.int32()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())],
                    names=["lang", "length", "part", "n"],
                )

    cut_up = words.select("lang", "part", "n").mapInArrow(cut, "lang string, length int, part string, n long")
    return cut_up.groupBy("lang", "length", "part").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Languages, rows of words and of n-grams, and the log frequency of each row in each language."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray

    def back_off(self, word: str) -> list[int]:
        """Rows of the longest n-grams of a word that are known."""
        get = self.grams.get
        for length in LENGTHS:
            found = [r for r in map(get, grams(word, length)) if r is not None]
            if found:
                return found
        return []

    def rows(self, words: list[str]) -> np.ndarray:
        """Scores of words; of those of which nothing is known, zeros."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        unseen, found, sizes = [], [], []
        at = np.full(len(words), -1, np.int64)
        for k, w in enumerate(words):
            row = self.words.get(w)
            if row is not None:
                at[k] = row
            elif own := self.back_off(w):
                unseen.append(k)
                found += own
                sizes.append(len(own))
        known = at >= 0
        out[known] = self.scores[at[known]]
        if unseen:
            sizes = np.array(sizes)
            out[unseen] = np.add.reduceat(self.scores[found], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        return out


def _logs(counts: DataFrame, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Parts seen ``LEAST`` times or more, and their smoothed log frequencies in each language."""
    by_part = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("own"))
    whole = counts.agg(F.count_distinct("part").alias("parts")).first().parts
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    kept = by_part.where(F.col("total") >= LEAST).select("part", "own").toArrow().combine_chunks()
    lists = kept.column("own").combine_chunks() if kept.num_rows else None
    table = np.zeros((kept.num_rows, len(langs)))
    if kept.num_rows:
        order = {lang: i for i, lang in enumerate(langs)}
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.values
        at = np.array([order[x] for x in values.field("lang").to_pylist()])
        table[np.repeat(np.arange(len(sizes)), sizes), at] = values.field("n").to_numpy()
    base = np.log(np.array([totals.get(x, 0) for x in langs]) + 0.5 * (whole + 1))
    return kept.column("part").to_pylist(), (np.log(table + 0.5) - base).astype(np.float32)


def fit(docs: DataFrame) -> Model:
    """Learn from documents with a language outside the held-out third, by a bounded sample."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND pmod(crc32(CAST(doc_id AS STRING)), 3) <> 1")
    picked = bounded_labels(known, "doc_id", "lang", PER_LANGUAGE, MAX_TRAIN_ROWS)
    words = stage(_word_counts(known.select("doc_id", "lang", "text"), picked), "language-words")
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    parts = stage(_gram_counts(words), "language-grams")
    names, scores = _logs(words, langs)
    tables = [scores]
    found: dict[str, int] = {}
    for length in LENGTHS:
        own, scores = _logs(parts.where(F.col("length") == length), langs)
        first = sum(map(len, tables))
        found.update({g: first + i for i, g in enumerate(own)})
        tables.append(scores)
    return Model(langs, {w: i for i, w in enumerate(names)}, found, np.concatenate(tables))


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep``, lang_pred and score (posterior of the predicted language).

    Scores of a text's words are added up and softened by the root of their number, as
    neighbouring words are not independent. Equal scores go to the smaller language code.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.grams, model.scores))

    def compute():
        known = Model(*sent.value)
        langs = known.langs

        def run(texts):
            names, sure = ["und"] * len(texts), np.zeros(len(texts))
            numbers: dict[str, int] = {}
            give = numbers.setdefault
            at, sizes = [], []
            for t in texts:
                own = words_of(t) if langs else []
                at += [give(w, len(numbers)) for w in own]
                sizes.append(len(own))
            told = [k for k, n in enumerate(sizes) if n]
            if told:
                n = np.array([sizes[k] for k in told])
                rows = known.rows(list(numbers)).astype(np.float64)[np.array(at)]
                totals = np.add.reduceat(rows, np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None]
                best = totals.argmax(1)
                odds = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
                for k, b, p in zip(told, best.tolist(), odds.tolist()):
                    names[k], sure[k] = langs[b], p
            return [pa.array(names, pa.string()), pa.array(sure)]

        return run

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return map_texts(docs, "text", added, compute, keep)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    A text that is null or has no letter is `und` with score 0, as is every text when there
    was nothing to learn from. A null doc_id is never learned from and not held out. Very long
    texts are read whole. Repeated rows get equal answers; an empty table gives no rows; other columns are not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    out = predict(docs.select("doc_id", "text"), fit(docs), ["doc_id"])
    held = F.coalesce(F.expr("pmod(crc32(CAST(doc_id AS STRING)), 3) = 1"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
