"""Categories, ranges and constants a column must respect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import as_decimal, as_whole
from bankmart.schemas import MONEY


def category_freq(df: DataFrame, field: str) -> DataFrame:
    return df.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("freq"))


def distinct_values(df: DataFrame, fields: Sequence[str] | str) -> DataFrame:
    fields = [fields] if isinstance(fields, str) else list(fields)
    return df.select(*fields).distinct()


def numeric_freq(
    df: DataFrame, field: str, cast: bool = True, descending: bool = False
) -> DataFrame:
    """Frequency of an integer column, sorted by value (as a number or, uncast, as text)."""
    value = as_whole(field) if cast else F.col(field)
    out = df.groupBy(value.alias("value")).agg(F.count("*").alias("freq"))
    return out.orderBy(F.desc("value") if descending else F.asc("value"))


def out_of_domain(df: DataFrame, field: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the catalogue with their frequency; NULL is not a value."""
    return category_freq(df.where(~F.col(field).isin(*allowed)), field)


def _outside(field: str, low, high) -> Column:
    value = as_decimal(field, MONEY)
    tests = []
    if low is not None:
        tests.append(value < low)
    if high is not None:
        tests.append(value > high)
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def out_of_range(
    df: DataFrame,
    field: str,
    low=None,
    high=None,
    form: str = "freq",
    context: Sequence[str] = (),
) -> DataFrame:
    """Values under ``low`` or over ``high`` as frequencies, as one count, or as rows."""
    bad = df.where(_outside(field, low, high))
    if form == "freq":
        return category_freq(bad, field)
    if form == "count":
        return bad.agg(F.count("*").alias("n"))
    return bad.select(*context, field)


def sign_text(df: DataFrame, field: str, context: Sequence[str]) -> DataFrame:
    """Rows whose text carries a minus sign, number or not."""
    return df.where(F.col(field).contains("-")).select(*context)


def group_minmax(df: DataFrame, by: str, field: str) -> DataFrame:
    value = as_decimal(field, MONEY)
    return df.groupBy(by).agg(
        F.count("*").alias("n"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )


def conditional_constant(
    df: DataFrame, by: str, when: str, field: str, constant: str
) -> DataFrame:
    """Rows of a class that should hold a constant in ``field`` and do not."""
    return df.where((F.col(by) == when) & (F.col(field) != constant))


def key_value_probe(
    df: DataFrame, wanted: dict[str, Sequence[str]], context: Sequence
) -> DataFrame:
    """Rows whose columns take one of the listed texts, for every listed column."""
    out = df
    for field, values in wanted.items():
        out = out.where(F.col(field).isin(*values))
    return out.select(*context)
