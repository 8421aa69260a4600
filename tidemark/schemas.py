"""Declared schemas: nothing is inferred on read."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """Schema of flat columns, written as in DDL."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_CHANNEL = _schema(
    "channel_id string, channel_title string, subscriber_count bigint, total_views bigint, video_count bigint"
)
RAW_VIDEO = _schema(
    "video_id string, title string, description string, published_at string, channel_id string, "
    "channel_title string, view_count bigint, like_count bigint, comment_count bigint, tags array<string>"
)
RAW_COMMENT = _schema(
    "video_id string, author string, comment_text string, published_at string, like_count bigint"
)
RAW = {"channel_info": RAW_CHANNEL, "video_info": RAW_VIDEO, "comments": RAW_COMMENT}

SHARE = _schema(
    "period date, gender string, age_group string, brand string, ratio double, updated_at timestamp"
)
SHARE_KEYS = ["period", "gender", "age_group", "brand"]

NEWS = _schema("source string, title string, link string, summary string, published string")

# Responses as the services send them; only the fields that are used are declared.
TREND_RESPONSE = "results array<struct<title string, data array<struct<period string, ratio double>>>>"
VIDEO_RESPONSE = (
    "items array<struct<"
    "snippet struct<title string, description string, publishedAt string, channelId string,"
    " channelTitle string, tags array<string>>,"
    "statistics struct<viewCount string, likeCount string, commentCount string>>>"
)
CHANNEL_RESPONSE = (
    "items array<struct<snippet struct<title string>,"
    "statistics struct<subscriberCount string, viewCount string, videoCount string>>>"
)
COMMENT_RESPONSE = (
    "items array<struct<snippet struct<topLevelComment struct<snippet struct<"
    "authorDisplayName string, textDisplay string, publishedAt string, likeCount bigint>>>>>"
)
SEARCH_RESPONSE = "items array<struct<id struct<videoId string>>>"
FEED_ENTRY = "title string, link string, summary string, published string"
