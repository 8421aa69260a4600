"""Catalog tables: create, replace, describe, drop."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import merge_statement

# Formats whose catalogs can replace a table in one commit.
REPLACING_FORMATS = {"iceberg", "delta"}


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", location: str | None = None) -> None:
    """Create-or-replace.

    Formats without a replacing commit get a new folder per version; the name is pointed
    at it only when it is complete, in one step if the columns are the same. Else the old
    table is renamed until the new one has its name, so a lost job leaves one of them, in
    the worst moment under ``<name>_before`` from where the next run goes on.
    """
    if fmt in REPLACING_FORMATS:
        writer = df.writeTo(name).using(fmt)
        if fmt == "iceberg":
            writer = writer.tableProperty("format-version", "2")
        writer.createOrReplace()
        return
    if not location:
        raise ValueError("a location is needed for this format")
    version = f"{location}/v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(version)
    spark = df.sparkSession
    before, after = f"{name}_before", f"{name}_after"
    # The tables are external: dropping a name deletes no data.
    if not table_exists(spark, name):
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{version}'")
    elif [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        drop_tables(spark, [before, after])
        spark.sql(f"CREATE TABLE {after} USING {fmt} LOCATION '{version}'")
        spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        spark.sql(f"ALTER TABLE {after} RENAME TO {name}")
    drop_tables(spark, [before])


def merge_table(source: DataFrame, name: str, keys: Sequence[str], update: bool = True) -> None:
    """Upsert (or insert-if-absent) into a table whose format has ``MERGE``."""
    view = f"merge_source_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        source.sparkSession.sql(merge_statement(name, view, keys, update))
    finally:
        source.sparkSession.catalog.dropTempView(view)


def create_share_table(spark: SparkSession, name: str, fmt: str = "parquet", location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (gender STRING, age_group STRING, brand STRING, ratio DOUBLE, "
        f"updated_at TIMESTAMP, period DATE) USING {fmt} PARTITIONED BY (period){where}"
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")


def drop_tables(spark: SparkSession, names: Iterable[str], purge: bool = False) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}{' PURGE' if purge else ''}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    """Drops the namespace with its tables and the data they own."""
    spark.sql(f"DROP NAMESPACE IF EXISTS {namespace} CASCADE")
