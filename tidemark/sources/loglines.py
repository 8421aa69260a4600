"""Scheduler log files as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_log_lines(
    spark: SparkSession, path: str | list[str], service: str = "airflow", log_type: str = "dag_logs"
) -> DataFrame:
    """Lines with the file and split they come from and the constant tags.

    ``at`` grows with the position of a line inside its split, and only that is used of it.
    """
    return spark.read.format("text").load(path).select(
        F.col("value").alias("message"),
        F.lit(service).alias("service"),
        F.lit(log_type).alias("log_type"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, 0-based and without gaps per file.

    Lines are counted inside each split; the splits' own counts, one small row
    each, give the offsets. A huge file is therefore never sorted in one task, as
    long as it can be split: a gzip file is one split and costs one task.
    """
    in_block = Window.partitionBy("file", "block").orderBy("at")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    others = [c for c in lines.columns if c not in ("file", "block", "at")]
    # Lines without file or block fall out of the join below. Left out here, both sides of it read the same rows: one shuffle.
    placed = lines.where(F.col("file").isNotNull() & F.col("block").isNotNull()).repartition("file", "block")
    counted = placed.withColumn("at", F.row_number().over(in_block))
    # The whole last line is taken along: the same columns are shuffled for it as for the lines, once.
    offsets = (
        counted.groupBy("file", "block")
        .agg(F.max(F.struct("at", *others)).alias("last"))
        .select("file", "block", F.coalesce(F.sum("last.at").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        counted.join(offsets, ["file", "block"])
        .withColumn("line_no", F.col("offset") + F.col("at") - 1)
        .drop("at", "offset")
    )
