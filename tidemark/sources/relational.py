"""The share table in a relational store or a table directory, and its high-watermark."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import SHARE_KEYS


def jdbc_options(
    url: str, table: str, lower: date, upper: date, partitions: int, column: str = "period", **extra: str
) -> dict[str, str]:
    """Reader options that split the table by date over ``partitions`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": lower.isoformat(),
        "upperBound": upper.isoformat(),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **extra,
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_high_watermark(spark: SparkSession, url: str, table: str, column: str = "period", **extra: str) -> DataFrame:
    """The largest value, found by the database itself."""
    query = f"SELECT MAX({column}) AS {column} FROM {table}"
    return spark.read.format("jdbc").options(url=url, query=query, **extra).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, **extra: str) -> None:
    """Batched inserts; ``mode="overwrite"`` empties the table but keeps its definition."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "truncate": "true", **extra}
    df.write.format("jdbc").mode(mode).options(**options).save()


def ordered_share(share: DataFrame) -> DataFrame:
    """The whole table in key order: range partitioned, then sorted."""
    return share.orderBy(*SHARE_KEYS)


def high_watermark(share: DataFrame, default: date, column: str = "period") -> DataFrame:
    """One row: the last collected day, or the default for an empty table."""
    return share.agg(F.coalesce(F.max(column), F.lit(default)).alias(column))


def latest_period(share: DataFrame, column: str = "period") -> DataFrame:
    """The newest day as a top-1; no row when the table is empty."""
    return share.select(column).orderBy(F.col(column).desc()).limit(1)
