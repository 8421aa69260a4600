from datetime import date

import pytest

from tidemark.operators import features, skew

DAY = date(2024, 2, 1)


def test_channel_tiers_are_strict(spark, rows):
    counts = [None, 10_000, 10_001, 100_000, 100_001, 1_000_000, 1_000_001, 3_000_000_000]
    df = spark.createDataFrame([(c,) for c in counts], "subscriber_count bigint")
    got = {r[0]: (r[1], r[2]) for r in features.channel_features(df).collect()}
    assert got == {
        None: (0, "bronze"),
        10_000: (0, "bronze"),
        10_001: (0, "silver"),
        100_000: (0, "silver"),
        100_001: (1, "gold"),
        1_000_000: (1, "gold"),
        1_000_001: (1, "platinum"),
        3_000_000_000: (1, "platinum"),
    }


def test_text_counters_do_not_fail(spark, rows):
    df = spark.createDataFrame([("200000",), ("none",)], "subscriber_count string")
    assert rows(features.channel_features(df)) == [("200000", 1, "gold"), ("none", 0, "bronze")]


def test_comment_features(spark):
    data = [
        ("x" * 21, 51), ("x" * 20, 51), ("x" * 21, 50), ("Good", 0), ("goodbye", 0), ("👍", 0), (None, 99), ("x" * 21, None),
    ]
    df = spark.createDataFrame(data, "comment_text string, like_count bigint")
    got = [tuple(r)[2:] for r in features.comment_features(df).collect()]
    assert got == [
        (21, 1, 0), (20, 0, 0), (21, 0, 0), (4, 0, 0), (7, 0, 1), (1, 0, 1), (None, 0, 0), (21, 0, 0),
    ]


def test_video_ratios(spark):
    df = spark.createDataFrame(
        [(0, 5, 1), (99, 10, 30), (20_000_001, 1, 0)], "view_count bigint, like_count bigint, comment_count bigint"
    )
    got = [tuple(r)[3:] for r in features.video_features(df).collect()]
    assert got == [(5.0, 1.0, 11.0), (0.1, 0.3, 0.5), (1 / 20_000_002, 0.0, 2 / 20_000_002)]


@pytest.fixture
def silver(spark):
    videos = features.video_features(
        spark.createDataFrame(
            [("v1", "c1", "t", 9, 1, 1), ("v2", "gone", "t", 9, 2, 1), ("v3", None, "t", 9, 3, 1)],
            "video_id string, channel_id string, channel_title string, view_count bigint, like_count bigint, "
            "comment_count bigint",
        )
    )
    channels = features.channel_features(
        spark.createDataFrame(
            [("c1", "t", 200_000, 5, 6), ("unused", "t", 1, 1, 1)],
            "channel_id string, channel_title string, subscriber_count bigint, total_views bigint, video_count bigint",
        )
    )
    return videos, channels


@pytest.mark.parametrize("salted", [None, True, False])
def test_training_features(silver, rows, salted):
    got = features.training_features(*silver, DAY, salted=salted)
    assert got.columns == [*features.FEATURE_COLUMNS, "feature_date"]
    assert rows(got) == [
        (9, 1, 0.1, 0.1, 0.3, 200_000, 5, 6, 1, "gold", DAY),
        (9, 2, 0.2, 0.1, 0.5, None, None, None, None, None, DAY),
        (9, 3, 0.3, 0.1, 0.7, None, None, None, None, None, DAY),
    ]


def test_training_features_tolerate_missing_columns_and_keep_keys(silver):
    videos, channels = silver
    got = features.training_features(videos.drop("engagement_score"), channels.drop("video_count"), DAY, keep_keys=True)
    assert got.columns[:2] == ["video_id", "channel_id"]
    assert "engagement_score" not in got.columns and "video_count" not in got.columns


def test_small_channel_side_is_broadcast(spark, silver, plan, tmp_path):
    videos, channels = silver
    channels.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert "BroadcastHashJoin" in plan(features.training_features(videos, stored, DAY))


def test_large_channel_side_is_joined_salted_by_a_shuffle(spark, silver, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = plan(features.training_features(*silver, DAY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (text, plan(features.training_features(*silver, DAY, salted=True))):
        assert "SortMergeJoin [channel_id" in text and "_salt" in text and "Broadcast" not in text


@pytest.mark.parametrize("text, size", [("-1", -1), ("52428800", 52_428_800), ("50m", 50 << 20), ("256KB", 256 << 10)])
def test_size_settings(text, size):
    assert skew._bytes(text) == size


def test_hot_key_is_found_and_spread(spark):
    left = spark.range(9_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k")
    hot = skew.hot_keys(left, "k", 0.1)
    assert "hot" in hot and len(hot) <= 11
    right = left.select("k").distinct().selectExpr("k", "length(k) AS n")
    joined = skew.salted_left_join(left, right, "k", ["hot"], ["id"], 8)
    expected = left.join(right, "k", "left")
    assert joined.exceptAll(expected.select(joined.columns)).count() == 0
    assert joined.count() == expected.count() == 9_000


def test_rows_without_key_are_spread_too(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(4_000).selectExpr("id", "CAST(NULL AS STRING) AS k")
        right = spark.createDataFrame([("a", 1)], "k string, n int")
        joined = skew.salted_left_join(left, right, "k", [], ["id"], 64)
        sizes = [n for n in joined.rdd.glom().map(len).collect() if n]
        assert sum(sizes) == 4_000 and max(sizes) < 2_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_standard_record(spark):
    row = features.standard_record(spark).first().asDict()
    assert row["like_count_x"] == 2000 and row["channel_tier"] == "gold" and len(row) == 11
