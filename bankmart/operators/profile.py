"""Column profiles of untyped tables: invalid, negative and missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import as_day, as_decimal, as_type, blank
from bankmart.schemas import MONEY, PERCENT, RATE

MISSING_WORDS = ("NULL", "NaN", "N/A")  # fixed value: texts that stand for "no date"


def invalid_tests(
    fields: Sequence[str], kind: str = RATE, strict: bool = False
) -> dict[str, Column]:
    return {f: ~blank(f) & as_decimal(f, kind, strict).isNull() for f in fields}


def invalid_date_tests(
    fields: Sequence[str], sentinels: Sequence[str] = MISSING_WORDS
) -> dict[str, Column]:
    return {f: ~blank(f) & as_day(f).isNull() & ~F.col(f).isin(*sentinels) for f in fields}


def negative_tests(
    fields: Sequence[str], kinds: Mapping[str, str] | None = None, kind: str = RATE
) -> dict[str, Column]:
    kinds = kinds or {}
    return {f: as_type(f, kinds.get(f, kind)) < 0 for f in fields}


def missing_tests(fields: Sequence[str]) -> dict[str, Column]:
    return {f: blank(f) for f in fields}


def _bad_cells(df: DataFrame, tests: Mapping[str, Column], step: str) -> DataFrame:
    """Frequency of the failing values per column.

    Rows without a failing cell are dropped before anything is exploded, so a wide table
    is not multiplied by its number of columns.
    """
    any_bad = reduce(or_, tests.values())
    cells = F.array_compact(
        F.array(*[
            F.when(test, F.struct(F.lit(name).alias("field"), F.col(name).alias("dirty_value")))
            for name, test in tests.items()
        ])
    )
    return (
        df.where(any_bad)
        .select(F.explode(cells).alias("cell"))
        .groupBy("cell.field", "cell.dirty_value")
        .agg(F.count("*").alias("freq"))
        .select(F.lit(step).alias("step"), "field", "dirty_value", "freq")
    )


def invalid_values(
    df: DataFrame,
    fields: Sequence[str],
    kind: str = RATE,
    strict: bool = False,
    step: str = "invalid_values",
) -> DataFrame:
    """Non-empty texts that are not numbers: (step, field, dirty_value, freq)."""
    return _bad_cells(df, invalid_tests(fields, kind, strict), step)


def invalid_dates(
    df: DataFrame,
    fields: Sequence[str],
    sentinels: Sequence[str] = MISSING_WORDS,
    step: str = "invalid_dates",
) -> DataFrame:
    """Non-empty texts that are not dates; words that mean "missing" are not counted."""
    return _bad_cells(df, invalid_date_tests(fields, sentinels), step)


def invalid_date_rows(
    df: DataFrame, fields: Sequence[str], context: Sequence[str] = ()
) -> DataFrame:
    """Rows in which one of the date columns does not convert (missing included)."""
    bad = reduce(or_, [as_day(f).isNull() for f in fields])
    return df.where(bad).select(*context, *fields)


def _unpivot_counts(counts: DataFrame, fields: Sequence[str], total: bool) -> DataFrame:
    """Turn a single row of per-field counts into one row per field."""
    pairs = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("n")) for f in fields
    ])
    keep = ["rows"] if total else []
    return counts.select(F.explode(pairs).alias("p"), *keep).select("p.field", "p.n", *keep)


def negatives(
    df: DataFrame,
    fields: Sequence[str],
    kinds: Mapping[str, str] | None = None,
    kind: str = RATE,
    step: str = "negatives",
) -> DataFrame:
    """Count of values under zero per column, in one pass; clean columns are left out."""
    tests = negative_tests(fields, kinds, kind)
    counts = df.agg(*[F.count_if(test).alias(f) for f, test in tests.items()])
    return (
        _unpivot_counts(counts, fields, total=False)
        .where("n > 0")
        .select(F.lit(step).alias("step"), "field", F.col("n").alias("freq"))
    )


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals, rounded half up."""
    return F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole).cast(PERCENT)


def missing(df: DataFrame, fields: Sequence[str], step: str = "missing") -> DataFrame:
    """NULL or empty cells per column, in one pass, worst column first."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(test).alias(f) for f, test in missing_tests(fields).items()],
    )
    return (
        _unpivot_counts(counts, fields, total=True)
        .select(
            F.lit(step).alias("step"), "field", F.col("n").alias("nulls"), "rows",
            percent(F.col("n"), F.col("rows")).alias("pct"),
        )
        .orderBy(F.desc("pct"), "field")
    )


def missing_rows(
    df: DataFrame,
    fields: Sequence[str] | str,
    context: Sequence[str],
    order: Sequence[str] = (),
    null_only: bool = False,
) -> DataFrame:
    """Rows in which one of the columns is missing, with the columns that explain it."""
    fields = [fields] if isinstance(fields, str) else list(fields)
    test = [F.col(f).isNull() if null_only else blank(f) for f in fields]
    out = df.where(reduce(or_, test)).select(*context)
    return out.orderBy(*order) if order else out


def top_missing(
    df: DataFrame,
    field: str,
    amount: str,
    context: Sequence[str],
    k: int = 20,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` rows with a missing column that carry the largest amounts."""
    order = [F.desc_nulls_last("_amount"), *[F.asc_nulls_first(c) for c in tie_break]]
    return (
        df.where(blank(field))
        .select(*context, as_decimal(amount, MONEY).alias("_amount"))
        .orderBy(*order)
        .limit(k)
        .drop("_amount")
    )
