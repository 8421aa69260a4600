"""Brand search shares per day, gender and age group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import AGE_GROUP_CODES, BRAND_GROUPS, FIRST_PERIOD, GENDER_LABELS
from tidemark.functions import columns as c
from tidemark.schemas import SHARE_KEYS
from tidemark.sources.relational import high_watermark

CELL = ["period", "gender", "age_group"]
# One conditional sum per brand keeps the generated code small up to here.
MAX_WIDE_BRANDS = 64


def brand_dim(spark: SparkSession, groups: Mapping[str, Sequence[str]] = BRAND_GROUPS) -> DataFrame:
    """(brand, keyword)."""
    rows = [(brand, keyword) for brand, keywords in groups.items() for keyword in keywords]
    return spark.createDataFrame(rows, "brand string, keyword string").distinct()


def age_dim(spark: SparkSession, groups: Mapping[str, Sequence[str]] = AGE_GROUP_CODES) -> DataFrame:
    """(age_code, age_group)."""
    rows = [(code, group) for group, codes in groups.items() for code in codes]
    return spark.createDataFrame(rows, "age_code string, age_group string")


def map_age_groups(trend: DataFrame, groups: Mapping[str, Sequence[str]] = AGE_GROUP_CODES) -> DataFrame:
    """Age codes to groups; codes of no group are not collected. The mapping is a fixed handful of rows."""
    dim = F.broadcast(age_dim(trend.sparkSession, groups))
    return trend.join(dim, "age_code").drop("age_code")


def label_gender(trend: DataFrame) -> DataFrame:
    """Gender codes to labels; rows of unknown codes are left out, as they would have no key. See ``unknown_genders``."""
    labelled = trend.withColumn("gender", c.gender_label(F.col("gender_code"))).drop("gender_code")
    return labelled.where(F.col("gender").isNotNull())


def unknown_genders(trend: DataFrame) -> DataFrame:
    """Rows left out because their gender code is unknown or missing, counted per code."""
    unknown = trend.where(c.gender_label(F.col("gender_code")).isNull())
    return unknown.groupBy("gender_code").agg(F.count(F.lit(1)).alias("rows"))


def union_cells(parts: Sequence[DataFrame]) -> DataFrame:
    """Separately collected result sets as one."""
    return reduce(DataFrame.unionByName, parts)


def gender_part(trend: DataFrame, code: str) -> DataFrame:
    return trend.where(F.col("gender_code") == code).drop("gender_code").withColumn(
        "gender", F.lit(GENDER_LABELS[code])
    )


def unknown_brands(trend: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Rows left out because no brand group has that title (or they have none), counted per title."""
    known = F.coalesce(F.col("brand").isin(list(brands)), F.lit(False))
    return trend.where(~known).groupBy("brand").agg(F.count(F.lit(1)).alias("rows"))


def _summed(trend: DataFrame, brands: Sequence[str]) -> DataFrame:
    """(cell, total, brand, value): every brand in every observed cell, 0 where it has no data."""
    brands = list(dict.fromkeys(brands))
    known = trend.where(F.col("brand").isin(brands)).withColumn("ratio", F.col("ratio").try_cast(c.RATIO_TYPE))
    zero = F.lit(0).cast(c.RATIO_TYPE)
    # One conditional sum per brand where the generated code stays small, else a sum per brand, gathered per cell:
    # the same numbers from one exchange or two. Ratios that are missing count as 0 in both.
    if len(brands) <= MAX_WIDE_BRANDS:
        wide = known.groupBy(*CELL).agg(
            F.coalesce(F.sum("ratio"), zero).alias("total"),
            *[
                F.sum(F.when(F.col("brand") == b, F.coalesce("ratio", zero)).otherwise(zero)).alias(f"b{i}")
                for i, b in enumerate(brands)
            ],
        )
        filled = F.array(
            *[F.struct(F.lit(b).alias("brand"), F.col(f"b{i}").alias("value")) for i, b in enumerate(brands)]
        )
        return wide.select(*CELL, "total", F.inline(filled))
    sums = known.groupBy(*CELL, "brand").agg(F.coalesce(F.sum("ratio"), zero).alias("value"))
    cells = sums.groupBy(*CELL).agg(
        F.sum("value").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("brand", "value"))).alias("values"),
    )
    spread = cells.select(*CELL, "total", "values", F.explode(F.array(*[F.lit(b) for b in brands])).alias("brand"))
    value = F.coalesce(F.try_element_at("values", F.col("brand")), zero)
    return spread.select(*CELL, "total", "brand", value.alias("value"))


def zero_fill(trend: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Summed ratio of every brand in every observed cell."""
    return _summed(trend, brands).select(*SHARE_KEYS, F.col("value").cast("double").alias("ratio"))


def normalise(trend: DataFrame, brands: Sequence[str], zero_total: str = "keep") -> DataFrame:
    """Ratios as percentages of their cell.

    The ratios of a cell must be on one scale. A cell that sums to zero keeps its
    zeros (full refresh) or is dropped (incremental).
    """
    if zero_total not in ("keep", "drop"):
        raise ValueError("zero_total must be 'keep' or 'drop'")
    summed = _summed(trend, brands)
    if zero_total == "drop":
        summed = summed.where(F.col("total") > 0)
    share = F.when(F.col("total") > 0, c.share_percent(F.col("value"), F.col("total"))).otherwise(
        F.col("value").cast("double")
    )
    return summed.select(*SHARE_KEYS, share.alias("ratio"))


def next_start(share: DataFrame, default: date = date.fromisoformat(FIRST_PERIOD)) -> date:
    """First day still to collect: the day after the watermark, or the default for an empty table."""
    day_before = default - timedelta(days=1)
    last = high_watermark(share, day_before).first()[0]
    return last + timedelta(days=1)


def incremental_slice(trend: DataFrame, start: date, run_date: date) -> DataFrame:
    """Days from ``start`` to the run date; nothing when the table is already up to date.

    The bounds are constants, so a table partitioned by day is pruned at planning.
    """
    return trend.where(F.col("period").between(F.lit(start), F.lit(run_date)))
