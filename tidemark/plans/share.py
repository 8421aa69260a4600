"""Search-share jobs over landed trend rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import AGE_GROUP_CODES, BRAND_GROUPS
from tidemark.operators import share as ops
from tidemark.operators.merge import stamp
from tidemark.schemas import SHARE, SHARE_KEYS
from tidemark.sinks.files import append_new, dual_export, gathered, publish_files, upsert_partitions, write_partitioned
from tidemark.sources.relational import ordered_share
from tidemark.workdir import folder_exists, swap_folder


def labelled(trend: DataFrame, ages: Mapping[str, Sequence[str]] = AGE_GROUP_CODES) -> DataFrame:
    """Request codes to labels."""
    return trend.transform(ops.label_gender).transform(ops.map_age_groups, ages)


def full_refresh(
    trend: DataFrame, path: str, brands: Sequence[str] = tuple(BRAND_GROUPS), run_ts: datetime | None = None
) -> None:
    """Computes all shares and replaces the table directory, whatever overwrite mode the session has.

    The new directory is complete before it takes the old one's place, so a lost job leaves the old table.
    """
    shares = stamp(ops.normalise(labelled(trend), brands, "keep"), run_ts)
    in_order = gathered(shares, ["period"]).sortWithinPartitions(*SHARE_KEYS)
    new = f"{path}.new-{uuid.uuid4().hex}"
    in_order.write.partitionBy("period").parquet(new)
    swap_folder(trend.sparkSession, new, path)


def read_share(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARE).parquet(path).select(*SHARE.fieldNames())


def incremental(
    spark: SparkSession,
    trend: DataFrame,
    path: str,
    run_date: date,
    brands: Sequence[str] = tuple(BRAND_GROUPS),
    update: bool = False,
    run_ts: datetime | None = None,
) -> bool:
    """Collects the days after the table's last one; False when there are none.

    The first run creates the table and starts at the default day. ``update``
    replaces rows of known keys, otherwise they are left alone.
    """
    if not folder_exists(spark, path):
        empty_share(spark, path)
    start = ops.next_start(read_share(spark, path))
    if start > run_date:
        return False
    fresh = ops.incremental_slice(trend, start, run_date)
    shares = stamp(ops.normalise(labelled(fresh), brands, "drop"), run_ts)
    (upsert_partitions if update else append_new)(spark, path, shares, SHARE_KEYS)
    return True


def dump_share(spark: SparkSession, path: str, parquet_path: str, csv_path: str) -> bool:
    """The table as Parquet and CSV, both in key order over all their files."""
    return dual_export(ordered_share(read_share(spark, path)), parquet_path, csv_path, SHARE_KEYS)


def publish_dump(spark: SparkSession, parquet_path: str, store_root: str, name: str) -> str:
    """Copies the Parquet dump to the object store and returns its place there."""
    target = f"{store_root}/processed/{name}"
    publish_files(spark, parquet_path, target, SHARE)
    return target


def empty_share(spark: SparkSession, path: str) -> None:
    """An empty table directory, which the first incremental run makes for itself."""
    write_partitioned(spark.createDataFrame([], SHARE).where(F.lit(False)), path, ["period"], mode="append")
