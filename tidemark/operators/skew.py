"""Left joins whose key may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; it takes no job and rather over- than underestimates."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Every key that holds more than ``share`` of the rows, at most ``1 / share`` of them.

    One pass over the key column without a shuffle of rows. It may name a key that
    is less frequent, which costs a few extra copies of that key's right rows.
    """
    found = df.select(key).freqItems([key], support=share).first()[0]
    return [value for value in found if value is not None]


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: Sequence, spread_by: Sequence[str], salts: int
) -> DataFrame:
    """Left join that spreads each hot key, and the rows without a key, over ``salts`` groups.

    Right rows are copied only for the hot keys, so the extra volume is bounded.
    """
    is_hot = F.col(key).isin(list(hot)) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts).cast("bigint"))
    none = F.lit(0).cast("bigint")
    spread = left.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, salt).otherwise(none))
    every = F.sequence(none, F.lit(salts - 1).cast("bigint"))
    copies = right.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(none))))
    return spread.join(copies.hint("merge"), [key, "_salt"], "left").drop("_salt")


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    salted: bool | None = None,
    hot_share: float | None = None,
    salts: int | None = None,
) -> DataFrame:
    """A plain join where the right side may be broadcast by its estimated bytes, else a salted one.

    Nothing is counted and no broadcast is forced: below its threshold Spark broadcasts, and replans by the real size. A
    key is hot if it holds more than an even share of the shuffle partitions.
    """
    conf = left.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    if salted is None:
        limit = _bytes(conf.get("spark.sql.autoBroadcastJoinThreshold"))
        salted = limit < 0 or estimated_bytes(right) > limit
    if not salted:
        return left.join(right, key, "left")
    share = hot_share or max(1e-4, 1 / partitions)
    return salted_left_join(left, right, key, hot_keys(left, key, share), spread_by, salts or partitions)


def _bytes(text: str) -> int:
    """A size setting like 52428800, 50m or 256KB."""
    number = text.lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(number[:-1]) << units[number[-1]] if number[-1:] in units else int(number)
