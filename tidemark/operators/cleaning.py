"""Raw rows to bronze rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_strings(df: DataFrame) -> DataFrame:
    """Trims spaces from text columns and joins array columns with commas."""

    def cleaned(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            column = F.trim(column)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws(",", column)
        return column.alias(field.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value (or NaN) in any of the columns.

    One test per column, so that Spark can hand those on plain columns to the scan
    and leave out those that cannot fail.
    """
    fields = [f for f in df.schema.fields if subset is None or f.name in subset]
    present = [F.col(f"`{f.name}`").isNotNull() for f in fields]
    numbers = [F.col(f"`{f.name}`") for f in fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.where(reduce(lambda a, b: a & b, present + [~F.isnan(n) for n in numbers], F.lit(True)))


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def remove_outliers(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Keeps rows that meet every ``column: "op value"`` condition; unknown is a miss."""
    tests = [F.expr(f"`{column}` {condition}") for column, condition in conditions.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def remove_short_text(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    return df.where(F.length(F.col(column)) >= min_length)


def add_run_date(df: DataFrame, run_date: date, column: str = "crawled_date") -> DataFrame:
    return df.withColumn(column, F.to_date(F.lit(run_date.isoformat())))


def to_bronze(
    raw: DataFrame, run_date: date, outliers: Mapping[str, str], text_column: str | None = None, min_length: int = 3
) -> DataFrame:
    """Clean, drop incomplete and repeated rows, then filter.

    Trimming neither makes nor fills a gap and a joined array has none, so gaps are
    looked for in the raw columns, where the scan can skip them. The filters stand after
    the duplicate removal; Catalyst moves them below it and to the scan.
    """
    plain = [f.name for f in raw.schema.fields if not isinstance(f.dataType, T.ArrayType)]
    rows = drop_nulls(raw, plain).transform(clean_strings).transform(dedup_rows)
    if text_column:
        rows = remove_short_text(rows, text_column, min_length)
    return add_run_date(remove_outliers(rows, outliers), run_date)


def bronze_channels(raw: DataFrame, run_date: date) -> DataFrame:
    return to_bronze(
        raw, run_date, {"subscriber_count": ">= 0", "total_views": ">= 0", "video_count": ">= 0"}
    )


def bronze_videos(raw: DataFrame, run_date: date) -> DataFrame:
    return to_bronze(
        raw, run_date, {"view_count": ">= 0", "like_count": ">= 0", "comment_count": ">= 0"}, text_column="title"
    )


def bronze_comments(raw: DataFrame, run_date: date) -> DataFrame:
    return to_bronze(raw, run_date, {"like_count": ">= 0"}, text_column="comment_text")
