"""Landed service responses (one JSON text per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import (
    CHANNEL_RESPONSE,
    COMMENT_RESPONSE,
    FEED_ENTRY,
    SEARCH_RESPONSE,
    TREND_RESPONSE,
    VIDEO_RESPONSE,
)


def _count(text: Column) -> Column:
    """Counters arrive as text and may be absent."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def _first_item(responses: DataFrame, key: str, name: str, schema: str, json: str) -> DataFrame:
    """The first item of each response. Exploding parses a text once; a filter would parse it again."""
    first = F.slice(F.from_json(json, schema)["items"], 1, 1)
    return responses.select(F.col(key).alias(name), F.explode(first).alias("item"))


def flatten_trend(responses: DataFrame, json: str = "response") -> DataFrame:
    """(…request columns…, period, brand, ratio), one row per brand and day; a period that is no date is null."""
    request = [c for c in responses.columns if c != json]
    return (
        responses.select(*request, F.explode(F.from_json(json, TREND_RESPONSE)["results"]).alias("group"))
        .select(*request, F.col("group.title").alias("brand"), F.explode("group.data").alias("entry"))
        .select(
            *request,
            F.try_to_date("entry.period").alias("period"),
            "brand",
            F.col("entry.ratio").alias("ratio"),
        )
    )


def flatten_videos(responses: DataFrame, video_id: str = "video_id", json: str = "response") -> DataFrame:
    """One row per found video; a response without items gives no row."""
    return _first_item(responses, video_id, "video_id", VIDEO_RESPONSE, json).select(
        "video_id",
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.description").alias("description"),
        F.col("item.snippet.publishedAt").alias("published_at"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.channelTitle").alias("channel_title"),
        _count(F.col("item.statistics.viewCount")).alias("view_count"),
        _count(F.col("item.statistics.likeCount")).alias("like_count"),
        _count(F.col("item.statistics.commentCount")).alias("comment_count"),
        F.coalesce(F.col("item.snippet.tags"), F.array().cast("array<string>")).alias("tags"),
    )


def flatten_channels(responses: DataFrame, channel_id: str = "channel_id", json: str = "response") -> DataFrame:
    return _first_item(responses, channel_id, "channel_id", CHANNEL_RESPONSE, json).select(
        "channel_id",
        F.col("item.snippet.title").alias("channel_title"),
        _count(F.col("item.statistics.subscriberCount")).alias("subscriber_count"),
        _count(F.col("item.statistics.viewCount")).alias("total_views"),
        _count(F.col("item.statistics.videoCount")).alias("video_count"),
    )


def flatten_comments(
    responses: DataFrame, max_results: int | None = None, video_id: str = "video_id", json: str = "response"
) -> DataFrame:
    """One row per top-level comment: all that landed, or the first ``max_results`` of each response."""
    items = F.from_json(json, COMMENT_RESPONSE)["items"]
    if max_results is not None:
        items = F.slice(items, 1, max_results)
    comment = "item.snippet.topLevelComment.snippet"
    return responses.select(F.col(video_id).alias("video_id"), F.explode(items).alias("item")).select(
        "video_id",
        F.col(f"{comment}.authorDisplayName").alias("author"),
        F.col(f"{comment}.textDisplay").alias("comment_text"),
        F.col(f"{comment}.publishedAt").alias("published_at"),
        F.col(f"{comment}.likeCount").alias("like_count"),
    )


def first_hits(responses: DataFrame, json: str = "response") -> DataFrame:
    """The first video found per search; searches without a hit keep a null."""
    rest = [c for c in responses.columns if c != json]
    items = F.from_json(json, SEARCH_RESPONSE)["items"]
    return responses.select(*rest, F.try_element_at(items, F.lit(1))["id"]["videoId"].alias("video_id"))


def normalise_feed(entries: DataFrame, source: str = "source", json: str = "entry") -> DataFrame:
    """Feed entries as news rows: missing texts become empty, a missing link stays null."""
    parsed = entries.select(F.col(source).alias("source"), F.from_json(json, FEED_ENTRY).alias("entry"))

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"entry.{name}"), F.lit("")).alias(name)

    return parsed.select(
        "source", text("title"), F.col("entry.link").alias("link"), text("summary"), text("published")
    )
