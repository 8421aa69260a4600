"""News topic to table, and feed entries to topic."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.news import keyword_filter, parse_news, to_messages
from tidemark.workdir import folder_exists


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def news_to_table(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    ingest_date: date | None = None,
    every: str | None = None,
    fmt: str = "parquet",
    drop_malformed: bool = False,
) -> StreamingQuery:
    """Starts the ingest: parse, stamp with the day of arrival, append to that day's partition.

    The sink commits each micro-batch once, so a restart on the checkpoint neither
    repeats nor loses rows. ``every`` is the service's trigger; without it the query
    takes what is there and ends.
    """
    day = F.lit(ingest_date) if ingest_date else F.current_date()
    rows = parse_news(messages, drop_malformed=drop_malformed).withColumn("ingest_date", day)
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
        .trigger(**_trigger(every))
        .start(path)
    )


def relevant_to_topic(
    news: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None, every: str | None = None,
    filters: dict | None = None, **options: str,
) -> StreamingQuery:
    """Starts the publisher: relevant rows as JSON messages to a topic (or text files)."""
    messages = to_messages(keyword_filter(news, **(filters or {})))
    writer = messages.writeStream.format(fmt).outputMode("append").options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start(path)


def once_writer(path: str, filters: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Publishes relevant rows of a batch below its number and then enters the number in the ledger beside the topic.

    A batch that is run again before it is entered replaces what it had written; one that is entered is left as it is.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, entry = batch.sparkSession, f"{path}.ledger/batch_id={batch_id}"
        if folder_exists(spark, f"{entry}/_SUCCESS"):
            return
        messages = to_messages(keyword_filter(batch, **(filters or {})))
        messages.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
        enter(spark, entry)

    return write


def enter(spark: SparkSession, entry: str) -> None:
    spark.range(1).select(F.current_timestamp().alias("entered")).write.mode("overwrite").parquet(entry)


def relevant_once(
    news: DataFrame, path: str, checkpoint: str, every: str | None = None, filters: dict | None = None
) -> StreamingQuery:
    """Starts the publisher whose consumers (``published``) see every message once, whatever is run again."""
    query = news.writeStream.option("checkpointLocation", checkpoint).foreachBatch(once_writer(path, filters))
    return query.trigger(**_trigger(every)).start()


def published(spark: SparkSession, path: str) -> DataFrame:
    """value of all messages of batches that the ledger has."""
    batches = spark.read.schema("entered timestamp, batch_id long").parquet(f"{path}.ledger").select("batch_id").distinct()
    messages = spark.read.schema("value string, batch_id long").text(path)
    return messages.join(batches, "batch_id", "left_semi").select("value")
