"""Bronze rows to silver features, and silver features to training rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import SENTIMENT_PATTERN, STANDARD_RECORD
from tidemark.functions import columns as c
from tidemark.operators.skew import left_join

# Columns of the training table, in order.
FEATURE_COLUMNS = [
    "view_count",
    "like_count_video",
    "like_to_view_ratio",
    "comment_to_view_ratio",
    "engagement_score",
    "subscriber_count",
    "total_views",
    "video_count",
    "is_big_channel",
    "channel_tier",
]

# Names that both sides have, and what the training table calls them.
CHANNEL_RENAMES = {
    "channel_title": "channel_title_channel",
    "crawled_date": "crawled_date_channel",
    "feature_date": "feature_date_channel",
}
VIDEO_RENAMES = {
    "channel_title": "channel_title_video",
    "crawled_date": "crawled_date_video",
    "feature_date": "feature_date_video",
    "like_count": "like_count_video",
}


def comment_features(comments: DataFrame, pattern: str = SENTIMENT_PATTERN) -> DataFrame:
    length = F.length("comment_text")
    return comments.withColumns(
        {
            "comment_length": length,
            "is_highlighted": c.flag((c.number("like_count") > 50) & (length > 20)),
            "sentiment_flag": c.sentiment(F.col("comment_text"), pattern),
        }
    )


def channel_features(channels: DataFrame) -> DataFrame:
    subscribers = c.number("subscriber_count")
    return channels.withColumns(
        {"is_big_channel": c.flag(subscribers > 100_000), "channel_tier": c.channel_tier(subscribers)}
    )


def video_features(videos: DataFrame) -> DataFrame:
    views, likes, comments = (c.number(n, "double") for n in ("view_count", "like_count", "comment_count"))
    return videos.withColumns(
        {
            "like_to_view_ratio": c.per_view(likes, views),
            "comment_to_view_ratio": c.per_view(comments, views),
            "engagement_score": c.per_view(likes * 2 + comments, views),
        }
    )


def with_feature_date(df: DataFrame, run_date: date) -> DataFrame:
    return df.withColumn("feature_date", F.lit(run_date))


def training_features(
    videos: DataFrame,
    channels: DataFrame,
    run_date: date,
    keep_keys: bool = False,
    extra_columns: tuple[str, ...] = (),
    **join_options,
) -> DataFrame:
    """Silver videos with their channel's features; videos of unknown channels stay."""
    wanted = [*(("video_id", "channel_id") if keep_keys else ()), *FEATURE_COLUMNS, *extra_columns]
    video_side = videos.withColumnsRenamed(VIDEO_RENAMES)
    channel_side = channels.withColumnsRenamed(CHANNEL_RENAMES)
    # Only what the result needs travels: the right side stays narrow enough to broadcast.
    right = channel_side.select("channel_id", *[n for n in wanted if n in channel_side.columns and n != "channel_id"])
    left_names = dict.fromkeys(["channel_id", "video_id", *wanted])
    left = video_side.select(*[n for n in left_names if n in video_side.columns])
    spread_by = [n for n in left.columns if n != "channel_id"]
    joined = left_join(left, right, "channel_id", spread_by, **join_options)
    return with_feature_date(joined.select(*[n for n in wanted if n in joined.columns]), run_date)


def standard_record(spark: SparkSession) -> DataFrame:
    """The one-row benchmark record."""
    return spark.createDataFrame([tuple(STANDARD_RECORD.values())], list(STANDARD_RECORD))
