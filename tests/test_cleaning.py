from datetime import date

from tidemark.operators import cleaning
from tidemark.schemas import RAW_CHANNEL, RAW_COMMENT, RAW_VIDEO

DAY = date(2024, 2, 1)


def test_clean_strings_trims_spaces_only_and_joins_arrays(spark, rows):
    df = spark.createDataFrame(
        [("  a ", "\tb ", ["x", None, "y"], 1), (None, "", None, None)], "a string, b string, c array<string>, d int"
    )
    assert rows(cleaning.clean_strings(df)) == [("a", "\tb", "x,y", 1), (None, "", "", None)]


def test_null_array_never_drops_a_row(spark, rows):
    df = spark.createDataFrame([("v", None), (None, ["x"])], "id string, tags array<string>")
    assert rows(cleaning.drop_nulls(cleaning.clean_strings(df))) == [("v", "")]


def test_drop_nulls_drops_nan(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", None)], "x string, y double")
    assert rows(cleaning.drop_nulls(df)) == [("a", 1.0)]


def test_drop_nulls_subset(spark, rows):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert rows(cleaning.drop_nulls(df, ["x"])) == [("a", None)]


def test_remove_outliers_needs_every_condition_and_drops_nulls(spark, rows):
    df = spark.createDataFrame([(0, 0), (-1, 5), (5, -1), (None, 1)], "a bigint, b bigint")
    assert rows(cleaning.remove_outliers(df, {"a": ">= 0", "b": ">= 0"})) == [(0, 0)]
    assert cleaning.remove_outliers(df, {}).count() == 4


def test_remove_short_text_counts_characters(spark, rows):
    df = spark.createDataFrame([("ab",), ("abc",), ("음료수",), ("음료",), (None,)], "t string")
    assert rows(cleaning.remove_short_text(df, "t")) == [("abc",), ("음료수",)]


def test_bronze_channels(spark, rows):
    raw = spark.createDataFrame(
        [
            ("c1", " padded ", 3_000_000_000, 1, 1),
            ("c1", "padded", 3_000_000_000, 1, 1),
            ("c2", "negative", -1, 1, 1),
            ("c3", None, 1, 1, 1),
            ("c4", "zero", 0, 0, 0),
        ],
        RAW_CHANNEL,
    )
    assert rows(cleaning.bronze_channels(raw, DAY)) == [
        ("c1", "padded", 3_000_000_000, 1, 1, DAY),
        ("c4", "zero", 0, 0, 0, DAY),
    ]


def test_bronze_videos(spark, rows):
    def video(vid, title, views=1, tags=None):
        return (vid, title, "d", "2024-01-01T00:00:00Z", "c1", "ch", views, 1, 1, tags)

    raw = spark.createDataFrame(
        [
            video("short", " ab "),
            video("kept", "abc", tags=["a", "b"]),
            video("kept", "abc ", tags=["a", "b"]),
            video("negative", "abc", views=-1),
            video("empty tags", "abc", tags=[]),
        ],
        RAW_VIDEO,
    )
    got = rows(cleaning.bronze_videos(raw, DAY), "video_id", "title", "tags", "crawled_date")
    assert got == [("empty tags", "abc", "", DAY), ("kept", "abc", "a,b", DAY)]


def test_bronze_comments(spark, rows):
    raw = spark.createDataFrame(
        [("v", "a", "ok text", "p", 0), ("v", None, "ok text", "p", 0), ("v", "a", "no", "p", 0), ("v", "a", "abc", "p", -1)],
        RAW_COMMENT,
    )
    assert rows(cleaning.bronze_comments(raw, DAY), "comment_text") == [("ok text",)]


def test_outlier_filter_reaches_the_scan_below_the_duplicate_removal(spark, tmp_path, plan):
    spark.createDataFrame([("c1", "t", 1, 1, 1)], RAW_CHANNEL).write.parquet(str(tmp_path / "c"))
    text = plan(cleaning.bronze_channels(spark.read.schema(RAW_CHANNEL).parquet(str(tmp_path / "c")), DAY))
    assert "GreaterThanOrEqual(subscriber_count,0)" in text
    assert "IsNotNull(channel_title)" in text
    assert text.count("Exchange") == 1
