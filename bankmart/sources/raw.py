"""Readers for the five raw tables. Every column is read as text, none is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bankmart.functions import as_type, blank, blank_to_null
from bankmart.schemas import RAW_COLUMNS, RAW_KEYS, RAW_TYPES, TEXT, text_schema
from bankmart.sources.staging import stage

BAD_LINE = "_bad_line"


# How the source system writes its files: missing cells as \\N, empty ones as "".
CSV = {"encoding": "UTF-8", "nullValue": "\\N", "emptyValue": "", "mode": "PERMISSIVE"}


@dataclass(frozen=True)
class RawTables:
    """The raw layer. Each attribute is an all-text DataFrame."""

    loans: DataFrame
    income: DataFrame
    balance: DataFrame
    payments: DataFrame
    customers: DataFrame


def read_raw(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "csv",
    empty_as_null: bool = False,
) -> DataFrame:
    """Load one raw table with its fixed columns as text.

    CSV keeps empty cells distinct from missing ones, and a header in another order than the
    fixed columns is an error; Parquet columns of other types are cast to text. ``empty_as_null`` turns empty text into NULL on the way in.
    """
    schema = text_schema(table)
    if fmt == "csv":
        df = spark.read.schema(schema).options(**CSV, header=True, enforceSchema=False).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[table]])
    if empty_as_null:
        df = df.select(*[blank_to_null(c).alias(c) for c in df.columns])
    return df


@dataclass(frozen=True)
class Loaded:
    """A raw table split at the read: rows of the right shape, and everything rejected."""

    good: DataFrame
    rejects: DataFrame


def load_raw(
    spark: SparkSession,
    path: str,
    table: str,
    types: Mapping[str, str] | None = None,
    keys: Sequence[str] | None = None,
    header: bool = True,
) -> Loaded:
    """Parse the CSV files of a raw table once into good rows and rejects.

    A line with too few or too many cells is no row of the table: it is rejected whole. A
    cell that does not convert to its declared type is listed, and its row stays good (the
    cleaned table will hold NULL there). ``rejects`` has the keys as text, ``kind`` (``line`` or
    ``cell``), ``field`` and ``dirty_value``; for a line the keys are those of its first cells that
    are there, the field is missing, and the value is the line as it was read.

    The parsed rows are written with their faults, so good rows and rejects come from one
    parse of the files. The header of every file is checked.
    """
    types, keys = types or RAW_TYPES[table], keys or RAW_KEYS[table]
    columns = RAW_COLUMNS[table]
    schema = T.StructType([*text_schema(table), T.StructField(BAD_LINE, T.StringType())])
    parsed = spark.read.schema(schema).options(
        **CSV, header=header, enforceSchema=False, columnNameOfCorruptRecord=BAD_LINE
    ).csv(path)
    staged = stage(parsed.withColumn("_cells", bad_cells(types)), f"raw-{table}", "zstd")
    whole = F.col(BAD_LINE).isNull()
    line = F.array(F.struct(
        F.lit("line").alias("kind"), F.lit(None).cast(TEXT).alias("field"), F.col(BAD_LINE).alias("dirty_value")
    ))
    faults = staged.select(*keys, F.inline(F.when(whole, F.col("_cells")).otherwise(line)))
    return Loaded(staged.where(whole).select(*columns), faults)


def bad_cells(types: Mapping[str, str]) -> Column:
    """Array of (kind, field, dirty_value) of a row's non-empty cells that do not convert."""
    none = F.array().cast("array<struct<kind:string,field:string,dirty_value:string>>")
    bad = {c: ~blank(c) & as_type(c, kind).isNull() for c, kind in types.items() if kind != TEXT}
    cells = [
        F.when(
            is_bad,
            F.array(F.struct(F.lit("cell").alias("kind"), F.lit(c).alias("field"), F.col(c).alias("dirty_value"))),
        ).otherwise(none)
        for c, is_bad in bad.items()
    ]
    # Most rows have none. Arrays are put together, as a filter's lambda would keep the casts from being compiled.
    return F.when(reduce(or_, bad.values(), F.lit(False)), F.concat(none, *cells)).otherwise(none)
