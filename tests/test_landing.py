import json
from datetime import date

from tidemark.sources import landing


def responses(spark, schema, *data):
    return spark.createDataFrame([(*d[:-1], json.dumps(d[-1], ensure_ascii=False)) for d in data], schema)


def test_trend(spark, rows):
    body = {
        "results": [
            {"title": "a", "data": [{"period": "2024-01-01", "ratio": 1.5}, {"period": "2024-01-01", "ratio": 2}]},
            {"title": "b", "data": []},
        ],
        "timeUnit": "date",
    }
    df = responses(spark, "gender_code string, response string", ("m", body), ("f", {}))
    day = date(2024, 1, 1)
    assert rows(landing.flatten_trend(df)) == [("m", day, "a", 1.5), ("m", day, "a", 2.0)]


def test_videos(spark):
    snippet = {"title": "t", "description": "d", "publishedAt": "p", "channelId": "c", "channelTitle": "ct"}
    full = {"items": [{"snippet": {**snippet, "tags": ["x"]}, "statistics": {"viewCount": "12", "likeCount": "many"}}]}
    bare = {"items": [{"snippet": snippet, "statistics": {}}]}
    df = responses(spark, "video_id string, response string", ("v1", full), ("v2", bare), ("v3", {"items": []}))
    got = [tuple(r) for r in landing.flatten_videos(df).orderBy("video_id").collect()]
    assert got == [("v1", "t", "d", "p", "c", "ct", 12, 0, 0, ["x"]), ("v2", "t", "d", "p", "c", "ct", 0, 0, 0, [])]


def test_channels_with_hidden_subscribers(spark, rows):
    body = {"items": [{"snippet": {"title": "t"}, "statistics": {"viewCount": "3000000000", "videoCount": "2"}}]}
    df = responses(spark, "channel_id string, response string", ("c", body), ("d", {"items": []}))
    assert rows(landing.flatten_channels(df)) == [("c", "t", 0, 3_000_000_000, 2)]


def test_comments_are_limited_per_response(spark, rows):
    def thread(i):
        fields = {"authorDisplayName": f"a{i}", "textDisplay": "t", "publishedAt": "p", "likeCount": i}
        return {"snippet": {"topLevelComment": {"snippet": fields}}}

    df = responses(
        spark, "video_id string, response string", ("v", {"items": [thread(i) for i in range(4)]}), ("w", {"items": []})
    )
    assert rows(landing.flatten_comments(df, 2), "author") == [("a0",), ("a1",)]
    assert landing.flatten_comments(df, None).count() == 4


def test_first_hit(spark, rows):
    hit = {"items": [{"id": {"videoId": "v1"}}, {"id": {"videoId": "v2"}}]}
    df = responses(spark, "keyword string, response string", ("k", hit), ("none", {"items": []}))
    assert rows(landing.first_hits(df)) == [("k", "v1"), ("none", None)]


def test_feed_defaults(spark, rows):
    df = responses(spark, "source string, entry string", ("s", {"title": "t"}), ("s", {"link": "l", "extra": 1}))
    assert rows(landing.normalise_feed(df)) == [("s", "", "l", "", ""), ("s", "t", None, "", "")]


def test_each_text_is_parsed_once(spark, plan):
    df = spark.createDataFrame([("v", "{}")], "video_id string, response string")
    assert plan(landing.flatten_videos(df)).count("from_json") == 1
