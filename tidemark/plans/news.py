"""News jobs over landed feed entries, as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.news import keyword_filter, to_messages
from tidemark.sources.landing import normalise_feed


def relevant_messages(entries: DataFrame, **filters) -> DataFrame:
    """Landed entries to the messages worth publishing."""
    return to_messages(keyword_filter(normalise_feed(entries), **filters))


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    messages.write.format(fmt).options(**options).mode("append").save(path)
