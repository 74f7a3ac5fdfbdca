"""From documents to packed training sequences: filter, deduplicate, mix, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bankmart.sources import stage
from llm.mixing import mixing_filter
from llm.packing import pack
from llm.quality import quality_filter
from llm.simhash import near_duplicate_filter
from llm.toxicity import toxicity_filter


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicate_filter(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix holds them."""
    return mixing_filter(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: Trained scores, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
