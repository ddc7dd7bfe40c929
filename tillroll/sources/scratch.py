"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Paths written inside each open ``discarded`` block, innermost last.
_open: list[list[str]] = []


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else one below the warehouse; on any master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


# Spark's own setting: shuffle files go when the execution that made them ends. Otherwise they
# stay until the driver happens to collect its garbage.
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the block remove their shuffle files when they end.

    Nothing reads these files again once a result is stored; a frame that is run twice makes
    them anew each time.
    """
    before = spark.conf.get(_REMOVAL, None)
    spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVAL)
        else:
            spark.conf.set(_REMOVAL, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once, write it as Parquet to the shared folder and read it back.

    This freezes values that a recomputation could change (a row's place in a
    range-partitioned sort) and lets later readers prune columns and survive the
    loss of executors without repeating the work behind ``df``. The shuffle files of that
    work are removed at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A stored table larger than this is shuffled in two rounds.
ROUND_BYTES = 1 << 28


def in_rounds(stored: DataFrame, key: Column) -> list[Column]:
    """Conditions that share out the values of ``key``, for steps that shuffle a whole stored table.

    Each share is run and ``written`` by itself, so the shuffle files of one are gone before
    the next begins: half of the disk for a second scan. A small table is one share. Rows
    with one value of ``key``, NULL included, are in one share.
    """
    size = stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    rounds = 1 if int(str(size)) <= ROUND_BYTES else 2
    return [F.pmod(F.xxhash64(key), F.lit(rounds)) == i for i in range(rounds)] if rounds > 1 else [F.lit(True)]


@contextmanager
def noted() -> Iterator[list[str]]:
    """Folders that ``written`` fills inside the block, for a caller that deletes them itself."""
    folders: list[str] = []
    _open.append(folders)
    try:
        yield folders
    finally:
        _open.pop()


@contextmanager
def passing(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as ``written`` for the length of the block; the table is deleted at its end."""
    with noted() as folders:
        table = written(df, label)
    try:
        yield table
    finally:
        for folder in folders:
            delete(df.sparkSession, folder)


@contextmanager
def discarded(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what ``written`` has put into the shared folder inside the block.

    Frames built in the block read these tables, so use or store them before it ends.
    """
    _open.append([])
    try:
        yield
    finally:
        for name in _open.pop():
            delete(spark, name)


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there, from whatever store it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
