"""All audits of a table in one scan, as a long-form report.

A metric is an aggregate with a name; a report evaluates any number of them in a single
aggregation and turns its one row into one row per metric. Frequencies of values, whose
number is not known beforehand, come from a second operator that explodes only the cells to count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import as_decimal
from bankmart.schemas import MONEY

#: Type of a reported value: counts, and sums of amounts with four decimals.
VALUE = "decimal(34,4)"


@dataclass(frozen=True)
class Metric:
    """One figure of a report: where it belongs, its name, and the aggregate that gives it."""

    step: str
    field: str
    metric: str
    value: Column


def row_count(field: str = "*") -> list[Metric]:
    return [Metric("rows", field, "rows", F.count("*"))]


def failing(step: str, tests: Mapping[str, Column], metric: str = "rows") -> list[Metric]:
    """Rows that fail each test; the key of a test is the column it is about."""
    return [Metric(step, field, metric, F.count_if(test)) for field, test in tests.items()]


def spread(step: str, fields: Sequence[str], kind: str = MONEY) -> list[Metric]:
    """Least, greatest and summed value of numeric texts."""
    figures = {"min": F.min, "max": F.max, "sum": F.sum}
    return [
        Metric(step, f, name, how(as_decimal(f, kind)))
        for f in fields for name, how in figures.items()
    ]


def by_label(step: str, field: str, labels: Sequence[str], test: Column) -> list[Metric]:
    """Failing rows of every label of a closed catalogue."""
    return [
        Metric(step, field, label, F.count_if(test & (F.col(field) == label))) for label in labels
    ]


def audit_report(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """(step, field, metric, value) of all metrics from one pass over the table.

    Only one row of partial aggregates per task is shuffled, however many metrics there are.
    """
    totals = df.agg(*[m.value.cast(VALUE).alias(f"_{i}") for i, m in enumerate(metrics)])
    rows = F.array(*[
        F.struct(
            F.lit(m.step).alias("step"), F.lit(m.field).alias("field"),
            F.lit(m.metric).alias("metric"), F.col(f"_{i}").alias("value"),
        )
        for i, m in enumerate(metrics)
    ])
    return totals.select(F.inline(rows))


def value_report(
    df: DataFrame, categories: Sequence[str], faults: Mapping[str, Mapping[str, Column]]
) -> DataFrame:
    """(step, field, value, freq): frequencies of all ``categories``, and of the failing values
    of every step of ``faults``, from one pass over the table.

    A row is exploded into its category cells and those of its cells that fail; they are counted
    before anything is shuffled.
    """
    def cell(step: str, field: str) -> Column:
        return F.struct(
            F.lit(step).alias("step"), F.lit(field).alias("field"), F.col(field).alias("value")
        )

    cells = [cell("values", c) for c in categories]
    cells += [
        F.when(test, cell(step, field))
        for step, tests in faults.items() for field, test in tests.items()
    ]
    every = df.select(F.inline(F.array_compact(F.array(*cells))))
    return every.groupBy("step", "field", "value").agg(F.count("*").alias("freq"))
