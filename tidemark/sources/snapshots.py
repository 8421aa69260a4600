"""Reading landed snapshots, exchange files and tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import RAW


def service_folder(service: str, source: str, kind: str, cycle: str) -> str:
    return "_".join([service, source, kind, cycle])


def raw_path(root: str, run_date: date, folder: str, entity: str) -> str:
    return f"{root}/raw/{run_date:%Y%m%d}/{folder}/{entity}/data.parquet"


def dump_name(service: str, source: str, kind: str, cycle: str, run_date: date) -> str:
    return f"{service}_{source}_{kind}_{cycle}_{run_date:%Y%m%d}.parquet"


def read_raw(
    spark: SparkSession, root: str, run_date: date, folder: str, entity: str, schema: StructType | None = None
) -> DataFrame:
    """One entity's raw snapshot, with its declared schema."""
    return spark.read.schema(schema or RAW[entity]).parquet(raw_path(root, run_date, folder, entity))


def read_header_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Header CSV with quoted texts, line breaks included; every column is a string unless a schema says otherwise.

    A file with line breaks in its texts can't be split, so exports of many rows are written as many files. Quoted empty
    texts stay empty; nothing between two commas is null.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"', emptyValue="", nullValue="\u0001")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_table(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A catalog table by name, through its connector when a format is given."""
    return spark.read.format(fmt).load(name) if fmt else spark.table(name)


def table_sample(spark: SparkSession, name: str, keys: Sequence[str], rows: int) -> DataFrame:
    """The first rows of a table in key order, asked for in SQL."""
    order = ", ".join(f"`{k}`" for k in keys)
    return spark.sql(f"SELECT * FROM {name} ORDER BY {order} LIMIT {int(rows)}")


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    return df.orderBy(*keys).limit(rows)


def read_feature_day(spark: SparkSession, path: str, day: date, column: str = "feature_date") -> DataFrame:
    """One day of a partitioned directory: only that partition is listed and read."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(day))
