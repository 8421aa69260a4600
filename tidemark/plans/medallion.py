"""Raw snapshots to bronze, silver, quality report and training features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import cleaning, features, quality
from tidemark.sinks.files import export_csv, write_partitioned
from tidemark.sinks.tables import create_namespace, replace_table
from tidemark.sources.snapshots import read_raw, read_table

BRONZE = {
    "channel_info": ("channel_info", cleaning.bronze_channels),
    "video_info": ("video_info", cleaning.bronze_videos),
    "comments_info": ("comments", cleaning.bronze_comments),
}
SILVER = {
    "comments_feature": ("comments_info", features.comment_features),
    "channel_feature": ("channel_info", features.channel_features),
    "video_feature": ("video_info", features.video_features),
}


def raw_to_bronze(
    spark: SparkSession,
    raw_root: str,
    table_root: str,
    folder: str,
    run_date: date,
    fmt: str = "parquet",
    tables: str | None = None,
) -> str:
    """Writes the three bronze tables and returns their namespace, named after the folder or ``tables``."""
    namespace = f"{tables or folder}_bronze"
    create_namespace(spark, namespace, f"{table_root}/{namespace}")
    for table, (entity, clean) in BRONZE.items():
        raw = read_raw(spark, raw_root, run_date, folder, entity)
        replace_table(clean(raw, run_date), f"{namespace}.{table}", fmt, f"{table_root}/{namespace}/{table}")
    return namespace


def bronze_to_silver(
    spark: SparkSession, table_root: str, folder: str, run_date: date, fmt: str = "parquet"
) -> str:
    """Writes the three feature tables and returns their namespace."""
    namespace = f"{folder}_silver"
    create_namespace(spark, namespace, f"{table_root}/{namespace}")
    for table, (bronze, derive) in SILVER.items():
        rows = features.with_feature_date(derive(read_table(spark, f"{folder}_bronze.{bronze}")), run_date)
        replace_table(rows, f"{namespace}.{table}", fmt, f"{table_root}/{namespace}/{table}")
    return namespace


def validate_bronze(spark: SparkSession, folder: str, min_rows: int = quality.MIN_ROWS) -> DataFrame:
    tables = [read_table(spark, f"{folder}_bronze.{name}") for name in BRONZE]
    return quality.quality_report(*tables, min_rows=min_rows)


def silver_to_features(spark: SparkSession, folder: str, feature_path: str, run_date: date, **options) -> None:
    """Adds the run's partition to the training features."""
    videos = read_table(spark, f"{folder}_silver.video_feature")
    channels = read_table(spark, f"{folder}_silver.channel_feature")
    write_partitioned(features.training_features(videos, channels, run_date, **options), feature_path)


def export_silver(spark: SparkSession, folder: str, table: str, keys: list[str], path: str, rows: int | None) -> None:
    """A silver table as exchange CSV: the first ``rows`` in key order, or all of them (None)."""
    export_csv(read_table(spark, f"{folder}_silver.{table}"), path, rows=rows, keys=keys)


def write_standard_record(spark: SparkSession, path: str) -> None:
    export_csv(features.standard_record(spark), path, rows=None)


def run_medallion(
    spark: SparkSession, raw_root: str, table_root: str, folder: str, feature_path: str, run_date: date,
    fmt: str = "parquet", min_rows: int = quality.MIN_ROWS, fail_on_issue: bool = False, tables: str | None = None,
) -> DataFrame:
    """The whole batch; returns the quality report. Namespaces are named after the folder or ``tables``."""
    raw_to_bronze(spark, raw_root, table_root, folder, run_date, fmt, tables)
    report = validate_bronze(spark, tables or folder, min_rows)
    if fail_on_issue:
        quality.require_pass(report)
    bronze_to_silver(spark, table_root, tables or folder, run_date, fmt)
    silver_to_features(spark, tables or folder, feature_path, run_date)
    return report
