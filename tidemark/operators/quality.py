"""Table checks: missing values, key uniqueness, size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import REPORT_DUPLICATES, REPORT_ENOUGH, REPORT_NONE, REPORT_TOO_FEW
from tidemark.functions.columns import row_digest

MAX_NULL_RATIO = 0.05
MIN_ROWS = 1000

COMMENT_KEY = ["video_id", "author", "published_at", "comment_text"]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def _ratio(nulls: Column, total: Column) -> Column:
    return F.when(total > 0, nulls / total).otherwise(F.lit(0.0))


def null_ratio(df: DataFrame, columns: Sequence[str], limit: float = MAX_NULL_RATIO) -> DataFrame:
    """One row per column, from a single pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(columns)],
    )
    per_column = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"nulls_{i}").alias("null_count"))
            for i, name in enumerate(columns)
        ]
    )
    ratio = _ratio(F.col("null_count"), F.col("total"))
    return counts.select("total", F.inline(per_column)).select(
        "column_name", "null_count", "total", ratio.alias("null_ratio"), (ratio > limit).alias("is_issue")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct keys occur more than once; missing keys form one group."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def quality_row(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    null_columns: Sequence[str],
    min_rows: int = MIN_ROWS,
    limit: float = MAX_NULL_RATIO,
) -> DataFrame:
    """One verdict row.

    The rows are first reduced per key, which uniqueness needs anyway; totals and
    missing values are sums over that, so the table is scanned and shuffled once.
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(null_columns)],
    )
    zero = F.lit(0).cast("bigint")
    totals = per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.count_if(F.col("n") > 1).alias("dups"),
        *[F.coalesce(F.sum(f"nulls_{i}"), zero).alias(f"nulls_{i}") for i in range(len(null_columns))],
    )
    total, dups = F.col("total"), F.col("dups")
    null_issues = F.concat_ws(
        " ",
        *[
            F.when(
                _ratio(F.col(f"nulls_{i}"), total) > limit,
                F.concat(F.lit(f"{name}: "), F.format_number(_ratio(F.col(f"nulls_{i}"), total) * 100, 1), F.lit("%")),
            )
            for i, name in enumerate(null_columns)
        ],
    )
    too_few = REPORT_TOO_FEW.format(min_rows=min_rows)
    failed = (null_issues != "") | (dups > 0) | (total < min_rows)
    return totals.select(
        F.lit(table).alias("table_name"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        F.when(null_issues != "", null_issues).otherwise(REPORT_NONE).alias("null_issues"),
        F.when(dups > 0, F.format_string(REPORT_DUPLICATES, dups)).otherwise(REPORT_NONE).alias("dup_issues"),
        F.when(total < min_rows, F.format_string(too_few, total)).otherwise(REPORT_ENOUGH).alias("row_issue"),
    )


def with_comment_id(comments: DataFrame, null_safe: bool = False) -> DataFrame:
    return comments.withColumn("comment_id", row_digest(COMMENT_KEY, null_safe))


def quality_report(
    channels: DataFrame, videos: DataFrame, comments: DataFrame, min_rows: int = MIN_ROWS
) -> DataFrame:
    """The verdicts of the three bronze tables."""
    rows = [
        quality_row(channels, "channel_info", ["channel_id"], ["channel_id", "channel_title"], min_rows),
        quality_row(videos, "video_info", ["video_id"], ["video_id", "title"], min_rows),
        quality_row(
            with_comment_id(comments), "comments_info", ["comment_id"], ["comment_id", "comment_text"], min_rows
        ),
    ]
    return reduce(DataFrame.unionByName, rows)


def require_pass(report: DataFrame) -> None:
    """Stops a job when a table failed; the report itself has one row per table."""
    failed = [row.table_name for row in report.where(F.col("status") == "FAIL").select("table_name").collect()]
    if failed:
        raise ValueError(f"quality check failed: {', '.join(sorted(failed))}")
