"""Dimensional modelling: dense keys, best match per key, calendar, key coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bankmart.sources.staging import stage

# --- fixed values: Spanish month names --------------------------------------------------
MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
    "septiembre", "octubre", "noviembre", "diciembre",
]
SHORT_MONTHS = [
    "ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic",
]


def closed_domain_key(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Dense 1..n key of a dimension whose values come from a catalogue: a few ratings,
    products or states. The window sees distinct values only; for dimensions that grow with
    the customers there is ``surrogate_key``, which numbers in the same order.
    """
    place = F.row_number().over(Window.orderBy(*[F.asc_nulls_first(c) for c in order]))
    return df.select(place.cast("long").alias(key), *df.columns)


def surrogate_key(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Add a dense 1..n key in the given order without sorting everything in one task.

    The rows are range-partitioned, sorted inside each partition and written once with
    their place (partition number in the upper bits, row number in the lower 33), so a lost
    executor cannot shift it. The key is that row number plus the rows of all partitions
    before, a table with one row per range partition, which bounds its broadcast. ``order``
    must identify a row, which also lets a frequent leading value be split.
    """
    by = [F.asc_nulls_first(c) for c in order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    staged = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), key)
    part = F.shiftright("_place", 33)
    placed = staged.select(
        "*", part.alias("_part"), (F.col("_place") - F.shiftleft(part, 33)).alias("_row")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_row") + 1).alias(key), *df.columns
    )


def extend_key(
    existing: DataFrame, df: DataFrame, order: Sequence[str], key: str
) -> DataFrame:
    """A dimension with the keys it has, and new rows numbered on from the last of them.

    Rows of ``df`` that the dimension knows (NULL equals NULL) keep their key, rows it lost keep
    theirs too, as facts may still point to them. Only new rows are sorted and written.
    """
    known = existing.select(*[F.col(c).alias(f"_known_{c}") for c in order])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in order])
    fresh = surrogate_key(df.select(*order).join(known, same, "left_anti"), order, key)
    last = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).scalar()
    numbered = fresh.select((F.col(key) + last).alias(key), *order)
    return existing.select(key, *order).unionByName(numbered)


def top1_per_key(
    df: DataFrame, keys: Sequence[str], priority: Sequence[Column], pick: str
) -> DataFrame:
    """Per key, ``pick`` of the row with the highest priority; keys come out unique."""
    return df.groupBy(*keys).agg(F.max_by(pick, F.struct(*priority)).alias(pick))


def calendar(spark: SparkSession, first: str = "2022-01-01", last: str = "2025-12-31") -> DataFrame:
    """One row per day with its year, month, Spanish month names, quarter and year-month."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("fecha")
    )
    return with_calendar_parts(days, "fecha")


def with_calendar_parts(df: DataFrame, date: str) -> DataFrame:
    month = F.month(date)
    names = F.array(*[F.lit(m) for m in MONTHS])
    short = F.array(*[F.lit(m) for m in SHORT_MONTHS])
    return df.select(
        "*",
        F.year(date).alias("ano"),
        month.alias("mes"),
        F.element_at(names, month).alias("nombre_mes"),
        F.element_at(short, month).alias("mes_corto"),
        F.concat(F.lit("T"), F.quarter(date).cast("string")).alias("trimestre"),
        F.date_format(date, "yyyy-MM").alias("ano_mes"),
    )


def calendar_of(df: DataFrame, date: str) -> DataFrame:
    """Calendar over the whole years that the dates of a table span."""
    bounds = df.agg(
        F.trunc(F.min(date), "year").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max(date), "year"), 12), 1).alias("last"),
    ).where(F.col("first").isNotNull())
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("fecha"))
    return with_calendar_parts(days, "fecha")


def role_date_sum(
    fact: DataFrame, dates: DataFrame, date_col: str, part: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Measures by a calendar attribute through a chosen date role of the fact.

    The fact is summed per day before it meets the calendar, which has a row per day.
    """
    daily = fact.groupBy(F.col(date_col).alias("fecha")).agg(
        *[F.sum(c).alias(name) for name, c in measures.items()]
    )
    return daily.join(dates.select("fecha", part), "fecha").groupBy(part).agg(
        *[F.sum(name).alias(name) for name in measures]
    )


def fk_coverage(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a dimension key, per key, after a load."""
    counts = fact.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in keys]
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("fk"), F.col(k).alias("n_null")) for k in keys])
    return counts.select("rows", F.explode(pairs).alias("p")).select(
        "p.fk", "rows", "p.n_null",
        F.try_divide(F.col("p.n_null").cast("double"), F.col("rows")).alias("null_share"),
    )
