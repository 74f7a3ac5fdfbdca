"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F


def fair_share(df: DataFrame) -> int:
    """Number of equal pieces a table should shuffle into: the shuffle partitions set."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: Sequence[str], share: int) -> DataFrame:
    """Keys that hold over ``1/share`` of the rows whose keys are not NULL, and how many
    pieces of that size (``_salts``) each of them is worth.

    Fewer than ``share`` keys can be hot and their pieces add up to less than twice that,
    whatever the size of the table. The total is the sum of the same counts, so the table
    is read once for both.
    """
    present = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    counts = present.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    pieces = F.col("_rows") * share
    return counts.where(pieces > total).select(
        *keys, F.ceil(pieces / total).cast("int").alias("_salts")
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    share: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join a large ``left`` that may have hot keys to ``right``.

    The first of ``keys`` decides what is hot. If it has more rows than a fair shuffle
    partition, it is cut into as many sub-keys as it fills partitions; only its right rows
    are repeated, once per sub-key. All other rows keep a single sub-key. NULL keys match
    nothing, as in SQL, and are spread. ``hot`` takes ``hot_keys`` of the first key that
    were found before, so that several joins of one table count it once.
    """
    keys = list(keys)
    share = share or fair_share(left)
    hot = F.broadcast(hot_keys(left, keys[:1], share) if hot is None else hot)
    # The partition id tells full copies of a row apart and, unlike a random number, gives
    # the same salt when a lost task runs again. Only rows that are cut are hashed.
    spread = F.xxhash64(*left.columns) + F.spark_partition_id()
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    pieces = F.when(no_key, F.lit(share)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, keys[0], "left").withColumn(
        "_salt", F.when(pieces > 1, F.pmod(spread, pieces).cast("int")).otherwise(0)
    ).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = right.join(hot, keys[0], "left").withColumn("_salt", F.explode(every)).drop("_salts")
    out = salted_left.join(salted_right, [*keys, "_salt"], how)
    return out.select(*left.columns, *[c for c in right.columns if c not in keys])
