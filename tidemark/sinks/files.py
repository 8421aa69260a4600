"""Writing directories and exchange files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.operators.merge import new_rows, upsert_by_key
from tidemark.schemas import RAW
from tidemark.workdir import drop_folder, staging


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together, so that not every task writes a file into every directory.

    Unlike a plain repartition, large partitions are split and small ones share a task.
    """
    return df.hint("rebalance", *[F.col(name) for name in by])


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("feature_date",),
    mode: str = "replace",
    fmt: str = "parquet",
    gather: bool = False,
) -> None:
    """Partitioned directory.

    ``replace`` swaps exactly the partitions present in ``df``, so a repeated run
    changes nothing; ``append`` adds files. ``gather`` is for rows that are spread
    over many directories; rows of one day need it not.
    """
    if gather:
        df = gathered(df, by)
    writer = df.write.format(fmt).partitionBy(*by)
    if mode == "append":
        writer.mode("append").save(path)
    elif mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:
        raise ValueError("mode must be 'replace' or 'append'")


def as_csv(df: DataFrame) -> DataFrameWriter:
    """A header CSV writer whose files ``read_header_csv`` reads back: quotes are doubled and line breaks stay inside quotes."""
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return df.write.mode("overwrite").options(header=True, quote='"', escape='"', **whole)


def flat(df: DataFrame, separator: str = ",") -> DataFrame:
    """Array columns as one text each, which is all a CSV can hold."""
    joined = {f.name: F.array_join(f.name, separator) for f in df.schema.fields if isinstance(f.dataType, ArrayType)}
    return df.withColumns(joined) if joined else df


def export_csv(df: DataFrame, path: str, *, rows: int | None, keys: Sequence[str] = ()) -> None:
    """Header CSV of the first ``rows`` in key order as one file, or of all rows (None) as many.

    A limit needs keys: without an order it would be another sample each time.
    """
    if rows is None:
        as_csv(flat(df.orderBy(*keys) if keys else df)).csv(path)
        return
    if not keys:
        raise ValueError("a limited export needs keys")
    # A single task is enough for a bounded sample.
    as_csv(flat(df.orderBy(*keys).limit(rows).coalesce(1))).csv(path)


def dual_export(df: DataFrame, parquet_path: str, csv_path: str, keys: Sequence[str] = ()) -> bool:
    """The same rows as Parquet and as CSV; nothing is left behind for an empty table.

    The CSV is made from the written Parquet, so the rows are computed only once. With ``keys`` it is put in their order
    again, as files are read back in the order of their sizes.
    """
    df.write.mode("overwrite").parquet(parquet_path)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    if written.isEmpty():
        drop_folder(df.sparkSession, parquet_path)
        return False
    as_csv(flat(written.orderBy(*keys) if keys else written)).csv(csv_path)
    return True


def publish_files(spark: SparkSession, source: str, target: str, schema: StructType) -> None:
    """Copies the Parquet files below a folder; other files stay behind."""
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    reader.parquet(source).write.mode("overwrite").parquet(target)


def publish_snapshot(
    spark: SparkSession, source_root: str, target_root: str, run_date: date, folder: str, entities: Iterable[str]
) -> None:
    """Copies the Parquet files of a landed run to its place in the object store, entity by entity."""
    for entity in entities:
        relative = f"raw/{run_date:%Y%m%d}/{folder}/{entity}"
        publish_files(spark, f"{source_root}/{relative}", f"{target_root}/{relative}/data.parquet", RAW[entity])


def _touched(spark: SparkSession, path: str, source: DataFrame, by: str) -> DataFrame | None:
    """The rows of the target's partitions that the source has rows for, or None when it has no rows.

    The driver sees the first and the last touched value only: they prune the listing, and a semi join does the rest.
    """
    low, high = source.agg(F.min(by), F.max(by)).first()
    if low is None:
        return None
    target = spark.read.schema(source.schema).parquet(path).where(F.col(by).between(low, high))
    return target.join(source.select(by).distinct(), by, "left_semi").select(*source.columns)


def append_new(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    by: str = "period",
    order_by: Sequence[str] = (),
) -> None:
    """Insert-if-absent into a directory partitioned by ``by``: only new rows are written.

    A run that is repeated after a failure finds what it already wrote.
    """
    with staging(source, "append") as rows:
        target = _touched(spark, path, rows, by)
        if target is not None:
            write_partitioned(new_rows(target, rows, keys, order_by), path, [by], mode="append", gather=True)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    by: str = "period",
    order_by: Sequence[str] = (),
) -> None:
    """Upsert into a partitioned directory.

    Only touched partitions are rebuilt. They are completed in a folder of their own
    first, so no partition is overwritten while it is being read.
    """
    with staging(source, "upsert-source") as rows:
        target = _touched(spark, path, rows, by)
        if target is not None:
            with staging(upsert_by_key(target, rows, keys, order_by), "upsert") as merged:
                write_partitioned(merged, path, [by], gather=True)


def write_by_day(df: DataFrame, path: str, run_date: date | None = None, by: str = "ingest_date") -> None:
    """Appends rows to the table directory of their day."""
    day = F.lit(run_date) if run_date else F.current_date()
    write_partitioned(df.withColumn(by, day), path, [by], mode="append")
