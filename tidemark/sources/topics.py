"""Message topics, bounded or as a stream. The source format and its options are arguments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def payload(messages: DataFrame) -> DataFrame:
    """Message bytes as UTF-8 text."""
    return messages.select(F.col("value").cast("string").alias("json_data"))


def read_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Everything in the topic from the earliest message on, as text."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
    return payload(spark.read.format(fmt).options(**options).load(path))


def stream_topic(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """The topic as an unbounded table; a first start sees only new messages unless told otherwise."""
    if fmt == "kafka":
        options = {"startingOffsets": "latest", **options}
    return payload(spark.readStream.format(fmt).options(**options).load(path))


def read_news_day(
    spark: SparkSession, path: str, day: date, fmt: str = "parquet", source_contains: str | None = None
) -> DataFrame:
    """One day of the news table, read by partition, optionally of matching sources only."""
    news = spark.read.format(fmt).load(path).where(F.col("ingest_date") == F.lit(day))
    return news.where(F.col("source").contains(source_contains)) if source_contains else news
