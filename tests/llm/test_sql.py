"""Corpus queries against their SQL."""

from collections import Counter

import duckdb
import pytest

from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_name_order(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    result = engine.sql(ORACLE[name])
    assert in_name_order(df.columns, df.collect()) == in_name_order(result.columns, result.fetchall())
