"""Every registered query against its SQL, and the shape of its plan."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from tidemark.entrypoints import logs, medallion, news, share

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["customer", "orders", "lineitem", "events", "documents"]

QUERIES = {name: query for group in (medallion, share, news, logs) for name, query in group.QUERIES.items()}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_name_order(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in data)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in plan
    result = engine.sql(oracle_sql()[name])
    assert in_name_order(df.columns, df.collect()) == in_name_order(result.columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
