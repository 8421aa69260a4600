"""Keyed merges of a source into a target."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    """First or last row per key. An aggregate: repeats of a hot key shrink before the shuffle."""
    rest = [n for n in source.columns if n not in keys]
    order = [*order_by, *[n for n in rest if n not in order_by]]
    if not order:
        return source.select(*keys).distinct()
    rows = source.groupBy(*keys).agg(pick(F.struct(*order)).alias("_row"))
    return rows.select(*keys, *[F.col("_row")[n].alias(n) for n in rest])


def _lacking(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key the right side lacks; null equals null, so a key with a null is a key like others."""
    others = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return left.join(others, same, "left_anti")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key the target lacks, the first per key."""
    first = _one_per_key(source, keys, order_by, F.min)
    return _lacking(first, target, keys).select(*target.columns)


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Target rows as they are, plus the new ones."""
    return target.unionByName(new_rows(target, source, keys, order_by))


def upsert_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Source wins: the last source row per key replaces or joins the target's."""
    last = _one_per_key(source, keys, order_by, F.max)
    return _lacking(target, last, keys).unionByName(last.select(*target.columns))


def stamp(df: DataFrame, run_ts: datetime | None = None, column: str = "updated_at") -> DataFrame:
    return df.withColumn(column, F.lit(run_ts) if run_ts else F.current_timestamp())


def merge_statement(target: str, source: str, keys: Sequence[str], update: bool = True) -> str:
    """``MERGE INTO`` for table formats that have it."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    matched = "WHEN MATCHED THEN UPDATE SET * " if update else ""
    return f"MERGE INTO {target} t USING {source} s ON {on} {matched}WHEN NOT MATCHED THEN INSERT *"
