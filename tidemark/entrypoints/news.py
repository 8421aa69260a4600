"""Registered queries: landed responses, news, topics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.entrypoints import bindings as b
from tidemark.fixed_values import BRAND_TERMS, MARKET_TERMS
from tidemark.operators import news as ops
from tidemark.plans.news import relevant_messages
from tidemark.schemas import NEWS
from tidemark.sinks.files import write_by_day
from tidemark.sources import landing, topics
from tidemark.streaming import news as streams
from tidemark.workdir import fresh_dir

# The given texts are invented words, so terms that occur in them join the fixed lists.
TERMS = {"brands": [*BRAND_TERMS, "eaux", "thnt"], "markets": [*MARKET_TERMS, "tione", "ciones"]}


def video_json_flatten(spark, sf):
    response = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.struct(
                        "title", "description", F.col("published_at").alias("publishedAt"),
                        F.col("channel_id").alias("channelId"), F.col("channel_title").alias("channelTitle"),
                        F.when(F.size("tags") > 1, F.col("tags")).alias("tags"),
                    ).alias("snippet"),
                    F.struct(
                        F.col("view_count").cast("string").alias("viewCount"),
                        F.nullif(F.col("like_count").cast("string"), F.lit("919")).alias("likeCount"),
                        F.col("comment_count").cast("string").alias("commentCount"),
                    ).alias("statistics"),
                )
            ).alias("items")
        )
    )
    return landing.flatten_videos(b.videos(spark, sf).select("video_id", response.alias("response"))).withColumn(
        "tags", F.concat_ws(",", "tags")
    )


def channel_json_flatten(spark, sf):
    response = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.struct(F.col("channel_title").alias("title")).alias("snippet"),
                    F.struct(
                        F.when(F.col("subscriber_count") >= 0, F.col("subscriber_count").cast("string")).alias("subscriberCount"),
                        F.col("total_views").cast("string").alias("viewCount"),
                        F.lit("not a number").alias("videoCount"),
                    ).alias("statistics"),
                )
            ).alias("items")
        )
    )
    return landing.flatten_channels(b.channels(spark, sf).select("channel_id", response.alias("response")))


def comments_json_flatten(spark, sf):
    """Every document is a response whose lines are the comments."""
    snippet = lambda line: F.struct(
        F.struct(
            F.struct(
                F.struct(
                    F.col("author").alias("authorDisplayName"), line.alias("textDisplay"),
                    F.col("published_at").alias("publishedAt"), F.col("like_count").alias("likeCount"),
                ).alias("snippet")
            ).alias("topLevelComment")
        ).alias("snippet")
    )
    items = F.transform(F.split("comment_text", "\n"), snippet)
    responses = b.comments(spark, sf).select("video_id", F.to_json(F.struct(items.alias("items"))).alias("response"))
    return landing.flatten_comments(responses)


def search_first_hit(spark, sf):
    hit = F.struct(F.struct(F.col("video_id").alias("videoId")).alias("id"))
    items = F.when(F.col("description").isNull(), F.slice(F.array(hit), 1, 0)).otherwise(F.array(hit, hit))
    responses = b.videos(spark, sf).select("title", F.to_json(F.struct(items.alias("items"))).alias("response"))
    return landing.first_hits(responses)


def _entries(spark, sf):
    return b.news(spark, sf).select(
        "source",
        F.to_json(F.struct("title", F.nullif("link", F.lit("https://example.org/1")).alias("link"), "summary")).alias("entry"),
    )


def _messages(spark, sf):
    return ops.to_messages(b.news(spark, sf))


def _topic(spark, sf):
    """The news as message files."""
    path = fresh_dir(spark, "topic")
    _messages(spark, sf).write.text(path)
    return path


def news_parse(spark, sf):
    """Every tenth message is broken and gives a marked row of nulls."""
    broken = F.when(F.col("title").endswith("7"), F.lit("{")).otherwise(F.to_json(F.struct(*NEWS.fieldNames())))
    messages = b.news(spark, sf).select(F.encode(broken, "UTF-8").alias("value"))
    return ops.parse_news(topics.payload(messages), mark_malformed=True)


def news_read_day(spark, sf):
    path = fresh_dir(spark, "news")
    write_by_day(b.news(spark, sf).where(F.col("source").endswith("1")), path, b.RUN_DATE - timedelta(days=1))
    write_by_day(b.news(spark, sf), path, b.RUN_DATE)
    return topics.read_news_day(spark, path, b.RUN_DATE, source_contains="src1")


def news_stream_ingest(spark, sf):
    """Two runs on one checkpoint: the second adds nothing."""
    topic, path, checkpoint = _topic(spark, sf), fresh_dir(spark, "news"), fresh_dir(spark, "offsets")
    for _ in range(2):
        messages = topics.stream_topic(spark, "text", topic)
        streams.news_to_table(messages, path, checkpoint, b.RUN_DATE).awaitTermination()
    return spark.read.parquet(path)


def news_stream_filter(spark, sf):
    """Landed entries as a stream, filtered, published as messages and read back."""
    landed, out, checkpoint = (fresh_dir(spark, n) for n in ("feed", "topic", "offsets"))
    _entries(spark, sf).write.parquet(landed)
    entries = spark.readStream.schema("source string, entry string").parquet(landed)
    query = streams.relevant_to_topic(landing.normalise_feed(entries), checkpoint, "text", out, filters=TERMS)
    query.awaitTermination()
    return ops.parse_news(topics.read_topic(spark, "text", out))


def news_published_once(spark, sf):
    """Landed entries as a stream, published under a ledger in two runs on one checkpoint, and read by it."""
    landed, out, checkpoint = (fresh_dir(spark, n) for n in ("feed", "topic", "offsets"))
    _entries(spark, sf).write.parquet(landed)
    for _ in range(2):
        entries = landing.normalise_feed(spark.readStream.schema("source string, entry string").parquet(landed))
        streams.relevant_once(entries, out, checkpoint, filters=TERMS).awaitTermination()
    return _as_messages(spark, streams.published(spark, out))


def _as_messages(spark, messages):
    return ops.parse_news(topics.payload(messages))


def _any_of(terms, column="content"):
    return " OR ".join(f"contains({column}, '{t}')" for t in dict.fromkeys(terms))


WITH_CONTENT = f"(SELECT *, title || ' ' || summary AS content FROM {b.sql(b.NEWS)} r)"
ALL_TERMS = [*TERMS["brands"], *TERMS["markets"]]
NEWS_COLUMNS = "source, title, link, summary, published"
RELEVANT = f"SELECT {NEWS_COLUMNS} FROM {WITH_CONTENT} c WHERE {_any_of(ALL_TERMS)}"
ENTRY_COLUMNS = "source, title, nullif(link, 'https://example.org/1') AS link, summary, published"

QUERIES = {
    "video_json_flatten": video_json_flatten,
    "channel_json_flatten": channel_json_flatten,
    "comments_json_flatten": comments_json_flatten,
    "search_first_hit": search_first_hit,
    "feed_entry_normalise": lambda s, d: landing.normalise_feed(_entries(s, d)),
    "keyword_filter": lambda s, d: ops.keyword_filter(b.news(s, d), **TERMS),
    "keyword_filter_both": lambda s, d: ops.keyword_filter(b.news(s, d), **TERMS, mode="and"),
    "keyword_semi_join": lambda s, d: ops.keyword_semi_join(b.news(s, d), ops.keyword_dim(s, *TERMS.values())),
    "keyword_semi_join_grams": lambda s, d: ops.keyword_semi_join(
        b.news(s, d), ops.keyword_dim(s, *TERMS.values()), max_pattern_terms=0
    ),
    "relevant_messages": lambda s, d: _as_messages(s, relevant_messages(_entries(s, d), **TERMS)),
    "news_parse": news_parse,
    "news_source_contains": lambda s, d: b.news(s, d).where(F.col("source").contains("src1")),
    "news_count_by_source": lambda s, d: ops.count_by_source(b.news(s, d)),
    "to_json_messages": lambda s, d: _as_messages(s, _messages(s, d)),
    "topic_batch_read": lambda s, d: ops.parse_news(topics.read_topic(s, "text", _topic(s, d))),
    "news_read_day": news_read_day,
    "news_stream_ingest": news_stream_ingest,
    "news_stream_filter": news_stream_filter,
    "news_published_once": news_published_once,
}

ORACLE = {
    "video_json_flatten": f"""SELECT * REPLACE (
  CASE WHEN like_count = 919 THEN 0 ELSE like_count END AS like_count,
  CASE WHEN len(tags) > 1 THEN array_to_string(tags, ',') ELSE '' END AS tags) FROM {b.sql(b.VIDEOS)} r""",
    "channel_json_flatten": f"""SELECT channel_id, channel_title,
  greatest(subscriber_count, 0) AS subscriber_count, total_views, CAST(0 AS BIGINT) AS video_count
FROM {b.sql(b.CHANNELS)} r""",
    "comments_json_flatten": f"""SELECT video_id, author, unnest(string_split(comment_text, chr(10)))
  AS comment_text, published_at, like_count FROM {b.sql(b.COMMENTS)} r""",
    "search_first_hit": f"""SELECT title, CASE WHEN description IS NOT NULL THEN video_id END AS video_id
FROM {b.sql(b.VIDEOS)} r""",
    "feed_entry_normalise": f"SELECT {ENTRY_COLUMNS} FROM {b.sql(b.NEWS)} r",
    "keyword_filter": RELEVANT,
    "keyword_filter_both": f"""SELECT {NEWS_COLUMNS} FROM {WITH_CONTENT} c
WHERE ({_any_of(TERMS["brands"])}) AND ({_any_of(TERMS["markets"])})""",
    "keyword_semi_join": RELEVANT,
    "keyword_semi_join_grams": RELEVANT,
    "relevant_messages": f"""SELECT {ENTRY_COLUMNS} FROM {WITH_CONTENT} c WHERE {_any_of(ALL_TERMS)}""",
    "news_parse": f"""SELECT {", ".join(f"CASE WHEN NOT bad THEN {c} END AS {c}" for c in NEWS_COLUMNS.split(", "))},
  bad AS malformed FROM (SELECT *, title LIKE '%7' AS bad FROM {b.sql(b.NEWS)} r) m""",
    "news_source_contains": f"SELECT * FROM {b.sql(b.NEWS)} r WHERE contains(source, 'src1')",
    "news_count_by_source": f"SELECT source, count(*) AS articles FROM {b.sql(b.NEWS)} r GROUP BY source",
    "to_json_messages": f"SELECT * FROM {b.sql(b.NEWS)} r",
    "topic_batch_read": f"SELECT * FROM {b.sql(b.NEWS)} r",
    "news_read_day": f"SELECT *, {b.D} AS ingest_date FROM {b.sql(b.NEWS)} r WHERE contains(source, 'src1')",
    "news_stream_ingest": f"SELECT *, {b.D} AS ingest_date FROM {b.sql(b.NEWS)} r",
    "news_stream_filter": f"""SELECT {ENTRY_COLUMNS} FROM {WITH_CONTENT} c WHERE {_any_of(ALL_TERMS)}""",
}
ORACLE["news_published_once"] = ORACLE["news_stream_filter"]
