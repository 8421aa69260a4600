"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workdir import drop_folder, fresh_dir

#: Rank of a null id: after every other one.
LAST_ID = 2**63 - 1


#: The folder that holds the package.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Settings of Python workers' allocators: what a task frees goes back to the system and is not kept for later stages.
FRUGAL = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import the package from where the driver did, and keep no memory that they don't use.

    That is all a local session or a cluster with the package at the same place needs; others get it by ``--py-files``.
    """
    for name, value in FRUGAL.items():
        spark.sparkContext.environment.setdefault(name, value)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [HOME])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ranked_id(name: str) -> Column:
    """The id as a never-null long; a null id ranks after all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def quoted(name: str) -> Column:
    """The column of this name, whatever the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@contextmanager
def _batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Bounds Arrow batches for what is run inside, and puts the session's setting back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that later steps don't recompute them.

    The table lies under ``spark.checkpoint.dir``; a lost executor costs a re-read, never a re-run. Batches that go to
    Python and back are kept small meanwhile, as several are held at a time on both sides.
    """
    path = fresh_dir(df.sparkSession, label)
    with _batch_bytes(df.sparkSession, 16 << 20):
        df.write.option("compression", "zstd").parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again.staged_path = path
    return again


def discard(*tables: DataFrame | None) -> None:
    """Deletes staged tables that nothing reads any more: what was made of them is staged, too."""
    for table in tables:
        if table is not None and getattr(table, "staged_path", None):
            drop_folder(table.sparkSession, table.staged_path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as one byte array and n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = column.cast(kind).fill_null(b"")
    _, offsets, data = column.buffers()
    width = np.int64 if kind == pa.large_binary() else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """Every text of a batch in UTF-8; a null is empty."""
    data, offsets = bytes_of(batch.column(name))
    view = memoryview(data)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(view[start:end])


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
