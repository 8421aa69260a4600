import hashlib

import pytest

from tidemark.operators import quality


def test_null_ratio_limit_is_strict(spark, rows):
    df = spark.range(20).selectExpr(
        "IF(id < 1, NULL, id) AS exact", "IF(id < 2, NULL, id) AS above", "id AS full"
    )
    assert rows(quality.null_ratio(df, ["exact", "above", "full"])) == [
        ("above", 2, 20, 0.1, True),
        ("exact", 1, 20, 0.05, False),
        ("full", 0, 20, 0.0, False),
    ]


def test_empty_table(spark, rows):
    df = spark.createDataFrame([], "k string, v string")
    assert rows(quality.null_ratio(df, ["v"])) == [("v", 0, 0, 0.0, False)]
    assert rows(quality.quality_row(df, "t", ["k"], ["v"])) == [("t", "FAIL", "없음", "없음", "0건 < 1000 기준")]
    assert rows(quality.quality_row(df, "t", ["k"], ["v"], min_rows=0)) == [("t", "PASS", "없음", "없음", "충족")]


def test_duplicate_keys_counts_keys_not_rows(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(2,)]


@pytest.mark.parametrize("n, issue", [(999, "999건 < 1000 기준"), (1000, "충족")])
def test_minimum_rows(spark, n, issue):
    row = quality.quality_row(spark.range(n), "t", ["id"], ["id"]).first()
    assert row.row_issue == issue and row.status == ("PASS" if issue == "충족" else "FAIL")


def test_messages_match_python_rounding(spark):
    for nulls, total in ((1, 16), (3, 40), (141, 2000), (143, 2000), (10, 10)):
        df = spark.range(total).selectExpr("id", f"IF(id < {nulls}, NULL, id) AS v")
        row = quality.quality_row(df, "t", ["id"], ["id", "v"], min_rows=1).first()
        assert row.null_issues == f"v: {nulls / total:.1%}"


def test_several_issues_in_one_row(spark, rows):
    df = spark.createDataFrame([("a", None, None), ("a", "x", "y")], "k string, v string, w string")
    assert rows(quality.quality_row(df, "t", ["k"], ["v", "w"])) == [
        ("t", "FAIL", "v: 50.0% w: 50.0%", "1건 중복", "2건 < 1000 기준")
    ]


def test_comment_id(spark):
    df = spark.createDataFrame(
        [("v", "a", "p", "t"), ("v", None, "p", "t")], "video_id string, author string, published_at string, comment_text string"
    )
    ids = [r.comment_id for r in quality.with_comment_id(df).collect()]
    assert ids == [hashlib.sha256(b"v||a||p||t").hexdigest(), hashlib.sha256(b"v||p||t").hexdigest()]
    moved = spark.createDataFrame(
        [("v", "p", None, "t")], "video_id string, author string, published_at string, comment_text string"
    )
    assert quality.with_comment_id(moved).first().comment_id == ids[1]
    assert (
        quality.with_comment_id(moved, null_safe=True).first().comment_id
        != quality.with_comment_id(df, null_safe=True).collect()[1].comment_id
    )


def test_report_is_one_scan_per_table(spark, tmp_path, plan):
    spark.range(10).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    assert plan(quality.quality_row(spark.read.parquet(str(tmp_path / "t")), "t", ["k"], ["v"])).count("FileScan") == 1


def test_require_pass(spark):
    bad = quality.quality_row(spark.range(3), "small", ["id"], ["id"])
    with pytest.raises(ValueError, match="small"):
        quality.require_pass(bad)
    quality.require_pass(quality.quality_row(spark.range(3), "small", ["id"], ["id"], min_rows=1))
