from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.fixed_values import BRAND_TERMS, MARKET_TERMS
from tidemark.functions.columns import contains_any
from tidemark.operators import news as ops
from tidemark.schemas import NEWS
from tidemark.sinks.files import write_by_day
from tidemark.sources import topics


@pytest.fixture
def articles(spark):
    data = [
        ("s1", "brand", "마시는 포카리스웨트", ""),
        ("s2", "market", "올해 시장 점유율", "성장세"),
        ("s3", "across", "온라인", "판매 늘어"),
        ("s4", "neither", "날씨", "맑음"),
        ("s5", "case", "GATORADE", "gatorade"),
        ("s6", "both", "Gatorade 신제품 출시", None),
    ]
    return spark.createDataFrame([(s, t, link, x, "") for s, link, t, x in data], NEWS)


def test_keyword_filter(articles, rows):
    assert rows(ops.keyword_filter(articles), "link") == [("across",), ("both",), ("brand",), ("market",)]
    assert rows(ops.keyword_filter(articles, mode="and"), "link") == [("both",)]


def test_semi_join_agrees_with_the_filter_either_way(spark, articles, rows):
    terms = ops.keyword_dim(spark, BRAND_TERMS, MARKET_TERMS)
    expected = rows(ops.keyword_filter(articles))
    for size in (5_000, 0):
        assert rows(ops.keyword_semi_join(articles, terms, size)) == expected
        assert rows(ops.keyword_semi_join(articles.union(articles), terms, size)) == sorted(expected * 2, key=repr)
        assert ops.keyword_semi_join(articles, terms.where(F.lit(False)), size).count() == 0
        assert ops.keyword_semi_join(articles, spark.createDataFrame([("",), (None,)], "term string"), size).count() == 6
        for term in ("강", "시장", "G", "날", "화", "없는말"):
            one = spark.createDataFrame([(term,)], "term string")
            assert rows(ops.keyword_semi_join(articles, one, size)) == rows(articles.where(F.contains(ops.content(), F.lit(term))))


def test_semi_join_compares_no_text_with_every_term(spark, articles, plan):
    terms = ops.keyword_dim(spark, BRAND_TERMS)
    for size in (5_000, 0):
        text = plan(ops.keyword_semi_join(articles, terms, size))
        assert "NestedLoop" not in text and "Cartesian" not in text


letters = st.text(alphabet="ab.*[]^-\\|?& 가나포é👍", max_size=8)


@settings(max_examples=25, deadline=None)
@given(st.lists(letters, max_size=12), st.lists(letters, min_size=1, max_size=20))
def test_contains_any_is_plain_containment(spark, terms, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(contains_any(F.col("t"), terms)).collect()]
    assert got == [any(term in text for term in terms) for text in texts]


def test_every_fixed_term_is_found(spark):
    terms = [*BRAND_TERMS, *MARKET_TERMS]
    df = spark.createDataFrame([(f"앞 {t} 뒤",) for t in terms] + [("아무 것도 아닌 글",)], "t string")
    assert df.where(contains_any(F.col("t"), terms)).count() == len(terms)


def test_messages_round_trip(spark, articles, rows):
    messages = ops.to_messages(articles)
    assert '"summary":null' in messages.where("value LIKE '%both%'").first().value
    assert "포카리" in messages.first().value
    assert rows(ops.parse_news(topics.payload(messages))) == rows(articles)


def test_malformed_messages(spark, rows):
    df = spark.createDataFrame(
        [('{"source":"s","extra":1}',), ("{",), ("null",)], "json_data string"
    )
    nothing = (None,) * 5
    assert rows(ops.parse_news(df)) == sorted([("s", None, None, None, None), nothing, nothing], key=repr)
    assert rows(ops.parse_news(df, drop_malformed=True)) == [("s", None, None, None, None)]
    assert ops.parse_news(df, mark_malformed=True).where("malformed").count() == 2


def test_day_read_prunes_partitions(spark, articles, tmp_path, plan):
    path = str(tmp_path / "news")
    write_by_day(articles, path, date(2024, 1, 1))
    write_by_day(articles, path, date(2024, 1, 2))
    day = topics.read_news_day(spark, path, date(2024, 1, 2), source_contains="s1")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(day)


def test_counts(articles, rows):
    assert rows(ops.count_by_source(articles.union(articles)))[0] == ("s1", 2)


def test_kafka_options():
    assert topics.kafka_options("h:1", "news")["startingOffsets"] == "latest"
