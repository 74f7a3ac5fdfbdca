"""Sinks: published views, and physical tables rebuilt in full, by month, or beside the old one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from bankmart.sources.staging import delete_folder, shuffles_removed

MANIFEST = "manifest"
MANIFEST_SCHEMA = "version long, folder string, rows long"


def mart_view(name: str, df: DataFrame) -> DataFrame:
    """Publish a cleaned, non-materialised view and return a DataFrame that reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


ROWS_PER_FILE = 5_000_000


def _writer(
    df: DataFrame, partition_by: Sequence[str], max_rows_per_file: int, seen: Observation | None = None
):
    """The rebalance hint clusters rows by the partition columns and lets AQE split a heavy
    value (a month with a third of all rows) over many writers and merge small ones. Rows are
    counted behind that shuffle, by the tasks that write: none of them counts twice.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).option("compression", "zstd")
    return writer.partitionBy(*partition_by) if partition_by else writer


def _write(
    parts: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str], max_rows_per_file: int,
    count: bool,
) -> tuple[DataFrame, int]:
    parts, rows = [parts] if isinstance(parts, DataFrame) else parts, 0
    spark = parts[0].sparkSession
    for i, part in enumerate(parts):
        seen = Observation() if count else None
        with shuffles_removed(spark):
            _writer(part, partition_by, max_rows_per_file, seen).mode("append" if i else "overwrite").parquet(path)
        rows += seen.get["rows"] if count else 0
    return spark.read.parquet(path), rows


def write_table(
    df: DataFrame | Sequence[DataFrame],
    path: str,
    partition_by: Sequence[str] = (),
    max_rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Drop and rebuild a physical Parquet table, then return a scan of it.

    A table that comes in parts (``in_rounds``) is written one after another, and the shuffles of
    each are removed before the next; its parts must not read the table.
    """
    return _write(df, path, partition_by, max_rows_per_file, False)[0]


# --- row counts as a by-product ----------------------------------------------------------

def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows when it is written, and where the count (``rows``) appears.

    The count belongs to the first action that runs on the result, so the result must occur
    once in what is written; reading the count waits for that.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_counted(
    df: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str] = (),
    max_rows_per_file: int = ROWS_PER_FILE,
) -> tuple[DataFrame, int]:
    """``write_table``, and the number of rows it wrote, without reading anything again."""
    return _write(df, path, partition_by, max_rows_per_file, True)


# --- versions ----------------------------------------------------------------------------

def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder, rows) of a published table, newest first."""
    try:
        found = spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}")
    except AnalysisException:
        found = spark.createDataFrame([], MANIFEST_SCHEMA)
    return found.orderBy(F.desc("version"), F.desc("folder"))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version of a table."""
    newest = versions(spark, path).first()
    if newest is None:
        raise ValueError(f"nothing published under {path}")
    return spark.read.parquet(f"{path}/{newest.folder}")


def publish_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2
) -> DataFrame:
    """Build a new version of a table beside the old one, then make it the current one.

    A version is a folder of its own. It becomes current by one appended line in the
    manifest, which is written only after all its files, so readers see the old table
    or the new one whole. A build that dies leaves the old table current and
    a folder that nothing points to. A new version may read the old one. The last
    ``keep`` versions stay for readers that began before; one writer at a time.
    """
    spark = df.sparkSession
    old = versions(spark, path).collect()
    folder = f"v-{uuid.uuid4().hex}"
    _, rows = write_counted(df, f"{path}/{folder}", partition_by)
    line = spark.createDataFrame([(old[0].version + 1 if old else 1, folder, rows)], MANIFEST_SCHEMA)
    line.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")
    for gone in old[max(keep, 1) - 1 :]:
        delete_folder(spark, f"{path}/{gone.folder}")
    return spark.read.parquet(f"{path}/{folder}")


# --- single months, and tables laid out for a join ----------------------------------------

def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Replace the partitions that occur in ``df``; the files of all others stay as they are.

    ``df`` must not read the partitions it replaces.
    """
    writer = _writer(df, partition_by, ROWS_PER_FILE)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int
) -> DataFrame:
    """A catalogue table at ``path`` whose rows are hashed by key into sorted files.

    Two tables with equal keys and buckets join, and either is grouped by the keys, without
    a shuffle. Rows are hashed before they are written, so there is one file for each bucket.
    """
    spaced = df.repartition(buckets, *by)
    spaced.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
