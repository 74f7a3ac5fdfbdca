"""Written intermediate tables in the shared checkpoint folder.

A staged table cuts the lineage, survives the loss of executors, and carries measured
file sizes, so the optimizer decides on a broadcast from the real size of the table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_TEMPORARY: ContextVar[list[str] | None] = ContextVar("temporary_stages", default=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="bankmart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


#: Removes the shuffle files of an execution at its end, instead of when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within the block are removed when it has been written.

    For writes, whose result is read from its files: nothing needs their shuffles afterwards.
    """
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def in_rounds(df: DataFrame, by: Sequence[Column | str], rounds: int) -> list[DataFrame]:
    """``df`` cut into ``rounds`` by a hash of some columns, to be written one after another.

    The shuffles of a round take that share of the disk. Each round runs the plan of ``df``: cut it
    before its joins, as no filter goes below a salt, and stage what all rounds look up.
    """
    if rounds < 2 or not by:
        return [df]
    place = F.pmod(F.xxhash64(*by), F.lit(rounds))
    return [df.where(place == i) for i in range(rounds)]


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once under the staging folder and return a scan of the written table.

    ``compression`` is that of the files, by default the session's; whole texts take far less room as ``zstd``.

    The folder is removed at the end of the surrounding ``temporary_stages``, if there is one.
    """
    return stage_rounds([df], name, compression)


def stage_rounds(parts: Sequence[DataFrame], name: str, compression: str | None = None) -> DataFrame:
    """``stage`` of a table that comes in parts, written one after another into one folder."""
    spark = parts[0].sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    opened = _TEMPORARY.get()
    if opened is not None:
        opened.append(path)
    for part in parts:
        with shuffles_removed(spark):
            part.write.mode("append").parquet(path, compression=compression)
    return spark.read.schema(parts[0].schema).parquet(path)


def release(staged: DataFrame) -> None:
    """Remove the folder of a staged table that nothing reads any more, before its block ends."""
    for folder in {file.rpartition("/")[0] for file in staged.inputFiles()}:
        delete_folder(staged.sparkSession, folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the file system that its path belongs to, if it is there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged within the block at its end, whether it fails or not.

    What is built within it must have been written by then: a DataFrame that still reads a staged
    table cannot be used after the block. Blocks can be nested.
    """
    paths: list[str] = []
    before = _TEMPORARY.set(paths)
    try:
        yield
    finally:
        _TEMPORARY.reset(before)
        for path in paths:
            delete_folder(spark, path)
