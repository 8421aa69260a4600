"""Where jobs put the data they write on the way."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, whose tasks all run on this machine, gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    system, place = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def swap_folder(spark: SparkSession, new: str, path: str) -> None:
    """Puts a complete new folder in the place of another.

    The old one is moved aside before and deleted after. A job lost in between leaves both complete, the old one under
    ``<path>.old-…``; running it again mends that.
    """
    system, place = _file_system(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    there = system.exists(place)
    if there and not system.rename(place, old):
        raise OSError(f"{path} could not be moved aside")
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(new), place):
        if there:
            system.rename(old, place)
        raise OSError(f"{new} could not be moved to {path}")
    if there:
        system.delete(old, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, with a known size."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``staged`` rows that are deleted when the work that needs them is done or has failed."""
    path = fresh_dir(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(df.sparkSession, path)
