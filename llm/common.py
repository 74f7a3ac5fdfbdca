"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

#: Characters that part words, as a Java regular expression and as text.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
#: Rows whose texts a Python worker holds as strings at one time.
ROWS_AT_ONCE = 200
#: Buckets in which the rows of a class are ranked.
SPREAD = 64


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or that with underscores before it, so that no column of ``df`` is hidden."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def trimmed(text: Column) -> Column:
    """The text without white space around it; null counts as empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def word_array(clean: Column) -> Column:
    """Words of a ``trimmed`` text; an empty text has none."""
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, f"{SPACE}+"))


def map_texts(
    df: DataFrame,
    text: str,
    added: Sequence[StructField],
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    keep: Sequence[str],
) -> DataFrame:
    """Columns ``keep`` of ``df`` and new columns computed from whole texts in Arrow batches.

    ``make`` runs once in each task and returns a function from texts to the new columns.
    Texts become Python strings a few hundred at a time, whatever the size of a batch.
    """
    keep = list(keep)
    names = keep + [f.name for f in added]
    read = keep + [text] * (text not in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(start, ROWS_AT_ONCE)
                new = compute(rows.column(read.index(text)).to_pylist())
                old = [rows.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*old, *new], names=names)
        # The worker lives on for other stages: give back what this task held.
        compute = None
        pa.default_memory_pool().release_unused()

    schema = StructType([*[df.schema[c] for c in keep], *added])
    return df.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


def bounded_labels(labelled: DataFrame, key: str, classes: str, per_class: int, in_all: int) -> DataFrame:
    """At most ``in_all`` rows, equally many of each class as far as they go, picked by a hash of the key.

    The pick depends on the keys alone, so reruns agree. Each class is ranked in ``SPREAD`` hash
    buckets, from each of which twice its part of ``per_class`` may come, so that a class with
    most rows is ranked in many tasks. Only keys and classes are shuffled.
    """
    order = [F.xxhash64(F.lit("pick"), F.col(key)), F.col(key)]
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(SPREAD)).alias("_bucket")
    place = F.row_number().over(Window.partitionBy(classes, "_bucket").orderBy(*order))
    ranked = labelled.select(key, classes, bucket).withColumn("_place", place)
    ranked = ranked.where(F.col("_place") <= -(-2 * per_class // SPREAD))
    return ranked.orderBy("_place", *order).limit(in_all).select(key, classes)
