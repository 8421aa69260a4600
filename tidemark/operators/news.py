"""News relevance and message encoding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import BRAND_TERMS, MARKET_TERMS
from tidemark.functions import columns as c
from tidemark.operators.skew import left_join
from tidemark.schemas import NEWS
from tidemark.workdir import staged

# Terms of one compiled pattern, terms that are compiled at all, and characters of a term that texts are looked up by.
TERMS_PER_PATTERN = 5_000
MAX_PATTERN_TERMS = 20_000
GRAM = 3


def content(title: str = "title", summary: str = "summary") -> Column:
    return F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(summary), F.lit("")))


def relevant(
    text: Column, brands: Sequence[str] = BRAND_TERMS, markets: Sequence[str] = MARKET_TERMS, mode: str = "or"
) -> Column:
    """Brand or market terms (``mode="and"``: both) occur in the text."""
    if mode == "and":
        return c.contains_any(text, brands) & c.contains_any(text, markets)
    return c.contains_any(text, [*brands, *markets])


def keyword_filter(
    news: DataFrame,
    brands: Sequence[str] = BRAND_TERMS,
    markets: Sequence[str] = MARKET_TERMS,
    mode: str = "or",
) -> DataFrame:
    """Relevant rows of a batch or a stream."""
    return news.where(relevant(content(), brands, markets, mode))


def keyword_dim(spark: SparkSession, *term_lists: Sequence[str]) -> DataFrame:
    """Distinct terms as a table."""
    return spark.createDataFrame([(t,) for terms in term_lists for t in terms], "term string").distinct()


def keyword_semi_join(
    news: DataFrame, dictionary: DataFrame, max_pattern_terms: int = MAX_PATTERN_TERMS, term: str = "term"
) -> DataFrame:
    """Rows whose content contains any dictionary term.

    The dictionary is counted first. A small one is compiled into patterns, each walked once per text. A larger one becomes
    an index. Neither way compares every text with every term.
    """
    terms = dictionary.select(F.col(term).alias("_term")).where(F.col("_term").isNotNull()).distinct()
    if terms.count() <= max_pattern_terms:
        found = sorted(row[0] for row in terms.collect())
        blocks = [found[i : i + TERMS_PER_PATTERN] for i in range(0, len(found), TERMS_PER_PATTERN)]
        return news.where(reduce(lambda a, b: a | b, [c.contains_any(content(), block) for block in blocks], F.lit(False)))
    if not terms.where(F.col("_term") == "").isEmpty():
        return news.where(content().isNotNull())
    own = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in news.columns]
    # Equal rows may share a number: they contain the same terms.
    key = F.struct(F.xxhash64(F.lit(1), *own), F.xxhash64(F.lit(2), *own))
    numbered = news.withColumn("_content", content()).withColumn("_row", key)
    candidates = candidate_terms(numbered, terms, "_content", "_row")
    tested = numbered.join(candidates, "_row")
    return tested.where(F.exists("_terms", lambda t: F.contains("_content", t))).select(*news.columns)


def candidate_terms(numbered: DataFrame, terms: DataFrame, text: str, row: str) -> DataFrame:
    """``row`` and ``_terms``, the terms that a text may contain, of the texts that may contain any.

    Texts are cut into grams once and only grams of the dictionary go on, which takes no shuffle as long as Spark may
    broadcast these. Their counts give every term its rarest gram, under which it stands in the index; a term with a gram
    that no text has is in no text. The terms of a gram are one row, so a hot gram adds one row per text, and texts of hot
    grams are spread over salted groups.
    """
    size = F.least(F.char_length("_term"), F.lit(GRAM))
    parts = [F.when(size == n, c.grams(F.col("_term"), n)) for n in range(1, GRAM + 1)]
    by_term = terms.select("_term", F.explode(F.coalesce(*parts)).alias("_gram"))
    wanted = staged(by_term.select("_gram").distinct(), "dictionary-grams")
    sizes = [r[0] for r in wanted.select(F.char_length("_gram")).distinct().collect()]
    every = F.concat(*[c.grams(F.col(text), n) for n in sizes]) if sizes else F.array().cast("array<string>")
    of_text = staged(numbered.select(row, F.explode(every).alias("_gram")).join(wanted, "_gram", "left_semi"), "grams")
    counts = of_text.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A gram that no text has comes first: such a term needs no place in the index.
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_gram")).alias("_least")
    placed = by_term.join(counts, "_gram", "left").groupBy("_term").agg(rarest).where("_least._n > 0")
    index = staged(placed.groupBy(F.col("_least._gram").alias("_gram")).agg(F.collect_list("_term").alias("_terms")), "gram-index")
    met = left_join(of_text, index, "_gram", spread_by=[row]).where(F.col("_terms").isNotNull())
    return met.groupBy(row).agg(F.flatten(F.collect_list("_terms")).alias("_terms"))


def to_messages(news: DataFrame) -> DataFrame:
    """One JSON text per row; missing values are written as null."""
    return news.select(F.to_json(F.struct(*news.columns), {"ignoreNullFields": "false"}).alias("value"))


def parse_news(messages: DataFrame, drop_malformed: bool = False, mark_malformed: bool = False) -> DataFrame:
    """JSON texts to news rows. Text that is no JSON object gives a row of nulls."""
    parsed = messages.select(F.from_json("json_data", NEWS).alias("data")).select("data.*")
    empty = reduce(lambda a, b: a & b, [F.col(n).isNull() for n in NEWS.fieldNames()])
    if drop_malformed:
        parsed = parsed.where(~empty)
    return parsed.withColumn("malformed", empty) if mark_malformed else parsed


def count_by_source(news: DataFrame) -> DataFrame:
    return news.groupBy("source").agg(F.count(F.lit(1)).alias("articles"))
