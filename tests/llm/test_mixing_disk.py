"""What the mixing stage leaves on disk."""

import os

from bankmart.sources import staging_root
from llm.mixing import mixing_filter


def test_mixing_keeps_its_copy_of_the_texts_as_zstd(spark):
    docs = spark.createDataFrame(
        [(i, "some words that come again " * 20, "en", "ab"[i % 2]) for i in range(20)], "doc_id long, text string, lang string, source string")
    root = staging_root(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(root))
    out = mixing_filter(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= set(range(20))
    folder = next(f for f in set(os.listdir(root)) - before if f.startswith("mixing-documents"))
    files = [f for f in os.listdir(f"{root}/{folder}") if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
