"""Keeping a frame that several later jobs read, and giving it back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_open: list[Kept] = []


class Kept:
    """What was held while this was open; ``release`` removes the tables and the caches."""

    def __init__(self) -> None:
        self.tables: list[tuple[SparkSession, str]] = []
        self.frames: list[DataFrame] = []

    def release(self) -> None:
        for spark, path in self.tables:
            remove(spark, path)
        for frame in self.frames:
            frame.unpersist()
        self.tables, self.frames = [], []


@contextmanager
def keeping() -> Iterator[Kept]:
    """Notes what is held within, for the caller to release when nothing reads it any more."""
    kept = Kept()
    _open.append(kept)
    try:
        yield kept
    finally:
        _open.remove(kept)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    files, place = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def shared_folder(df: DataFrame) -> str | None:
    """The folder the cluster shares for cut lineage, from the session."""
    return df.sparkSession.conf.get("spark.checkpoint.dir", None)


def hold(df: DataFrame) -> DataFrame:
    """The frame as a table in the cluster's shared folder, or cached where there is none.

    The table is computed once, outlives lost executors, ends the lineage of the model
    steps, and later scans still read only the columns they need. The cache spills to
    disk and is recomputed when an executor goes. Both stay until ``keeping`` gives them back.
    """
    folder = shared_folder(df)
    if folder:
        return written(df, folder)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    for kept in _open[-1:]:
        kept.frames.append(held)
    return held


def written(df: DataFrame, folder: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/held-{uuid4().hex}"
    for kept in _open[-1:]:
        kept.tables.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
