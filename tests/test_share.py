from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.fixed_values import AGE_GROUP_CODES, BRAND_GROUPS
from tidemark.operators import share as ops
from tidemark.plans import share as plans
from tidemark.sources import relational

BRANDS = ["a", "b", "c"]
DAY = date(2024, 1, 2)
SCHEMA = "period date, gender string, age_group string, brand string, ratio double"


def trend(spark, *data):
    return spark.createDataFrame([(DAY, "male", "20대", b, r) for b, r in data], SCHEMA)


def test_every_brand_appears_and_repeats_are_summed(spark, rows):
    got = rows(ops.zero_fill(trend(spark, ("a", 1.1), ("a", 2.2), ("b", 0.7)), BRANDS), "brand", "ratio")
    assert got == [("a", 3.3), ("b", 0.7), ("c", 0.0)]


def test_shares(spark, rows):
    got = rows(ops.normalise(trend(spark, ("a", 1.0), ("b", 2.0)), BRANDS), "brand", "ratio")
    assert got == [("a", 33.33), ("b", 66.67), ("c", 0.0)]


def test_zero_total_is_kept_or_dropped(spark, rows):
    cell = trend(spark, ("a", 0.0))
    assert rows(ops.normalise(cell, BRANDS, "keep"), "brand", "ratio") == [("a", 0.0), ("b", 0.0), ("c", 0.0)]
    assert ops.normalise(cell, BRANDS, "drop").count() == 0
    with pytest.raises(ValueError):
        ops.normalise(cell, BRANDS, "other")


def test_unknown_brands_stay_out_and_are_counted(spark, rows):
    cell = trend(spark, ("a", 1.0), ("z", 9.0), ("z", 1.0))
    assert rows(ops.normalise(cell, BRANDS), "brand", "ratio")[0] == ("a", 100.0)
    assert rows(ops.unknown_brands(cell, BRANDS)) == [("z", 2)]


def test_long_brand_list_gives_the_same_rows(spark, rows, monkeypatch):
    data = trend(spark, ("a", 1.25), ("b", 2.5), ("b", 1.0))
    short = rows(ops.normalise(data, BRANDS))
    monkeypatch.setattr(ops, "MAX_WIDE_BRANDS", 0)
    assert rows(ops.normalise(data, BRANDS)) == short


def test_short_brand_list_needs_one_exchange(spark, plan):
    text = plan(ops.normalise(trend(spark, ("a", 1.0)), BRANDS))
    assert text.count("Exchange") == 1


def test_cells_sum_to_hundred(spark):
    data = spark.range(500).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) AS period", "'male' AS gender", "'20대' AS age_group",
        "element_at(array('a','b','c'), CAST(id % 3 AS INT) + 1) AS brand", "CAST((id * 37) % 101 AS DOUBLE) / 7 AS ratio",
    )
    sums = ops.normalise(data, BRANDS).groupBy("period").agg(F.sum("ratio").alias("s")).collect()
    assert len(sums) == 9 and all(abs(r.s - 100) <= 0.005 * len(BRANDS) + 1e-9 for r in sums)


def test_dims(spark, rows):
    assert ops.brand_dim(spark).count() == 11 and len(BRAND_GROUPS) == 5
    assert sorted(c for c, _ in rows(ops.age_dim(spark))) == sorted(c for cs in AGE_GROUP_CODES.values() for c in cs)


def test_codes_to_labels(spark, rows):
    df = spark.createDataFrame([("m", "2"), ("f", "11"), ("f", "1")], "gender_code string, age_code string")
    assert rows(plans.labelled(df), "gender", "age_group") == [("female", "60대 이상"), ("male", "10대")]


def test_watermark(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(relational.high_watermark(empty, date(2024, 1, 1))) == [(date(2024, 1, 1),)]
    assert ops.next_start(empty) == date(2024, 1, 1)
    assert relational.latest_period(empty).count() == 0
    loaded = trend(spark, ("a", 1.0))
    assert ops.next_start(loaded) == date(2024, 1, 3)
    assert rows(relational.latest_period(loaded)) == [(DAY,)]


@pytest.fixture
def landed(spark):
    return spark.range(600).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) AS period",
        "IF(id % 2 = 0, 'm', 'f') AS gender_code",
        "CAST(id % 11 + 1 AS STRING) AS age_code",
        "element_at(array('a','b','c','z'), CAST(id % 4 AS INT) + 1) AS brand",
        "CAST((id * 37) % 101 AS DOUBLE) / 4 AS ratio",
    )


@pytest.mark.parametrize("update", [False, True])
def test_incremental_in_slices_equals_full_refresh(spark, landed, rows, tmp_path, update):
    full, sliced = str(tmp_path / "full"), str(tmp_path / "sliced")
    plans.full_refresh(landed, full, BRANDS)
    plans.empty_share(spark, sliced)
    for day in (3, 3, 6, 10):
        moved = plans.incremental(spark, landed, sliced, date(2024, 1, day), BRANDS, update)
    assert moved
    assert not plans.incremental(spark, landed, sliced, date(2024, 1, 10), BRANDS, update)
    columns = ["period", "gender", "age_group", "brand", "ratio"]
    expected = plans.read_share(spark, full)
    totals = expected.groupBy("period", "gender", "age_group").agg(F.sum("ratio").alias("t")).where("t > 0")
    expected = expected.join(totals, ["period", "gender", "age_group"], "left_semi")
    assert rows(plans.read_share(spark, sliced), *columns) == rows(expected, *columns)


def test_dump_is_ordered_and_empty_table_writes_nothing(spark, landed, tmp_path):
    path = str(tmp_path / "share")
    plans.empty_share(spark, path)
    assert not plans.dump_share(spark, path, str(tmp_path / "p0"), str(tmp_path / "c0"))
    plans.full_refresh(landed, path, BRANDS)
    assert plans.dump_share(spark, path, str(tmp_path / "p"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == plans.read_share(spark, path).count()


def test_jdbc_options_split_by_date():
    options = relational.jdbc_options("jdbc:x", "t", date(2024, 1, 1), date(2024, 2, 1), 16, user="u")
    assert options["partitionColumn"] == "period" and options["numPartitions"] == "16"
    assert options["lowerBound"] == "2024-01-01" and options["user"] == "u"


@pytest.mark.parametrize("count", [64, 65])
def test_missing_ratios_and_repeated_brands_on_both_sides_of_the_width(spark, rows, count):
    brands = [f"b{i}" for i in range(count)]
    data = trend(spark, ("b0", 3.0), ("b1", None), ("b1", 1.0), ("b2", None))
    got = rows(ops.zero_fill(data, [*brands, "b0"]), "brand", "ratio")
    assert len(got) == count and dict(got) == dict.fromkeys(brands, 0.0) | {"b0": 3.0, "b1": 1.0}
    assert dict(rows(ops.normalise(data, brands), "brand", "ratio"))["b1"] == 25.0
    nothing = trend(spark, ("b2", None))
    assert {r[1] for r in rows(ops.normalise(nothing, brands), "brand", "ratio")} == {0.0}


def test_large_ratios_do_not_fail(spark, rows):
    assert rows(ops.zero_fill(trend(spark, ("a", 1e12), ("b", float("nan"))), BRANDS), "brand", "ratio") == [("a", 1e12), ("b", 0.0), ("c", 0.0)]


def test_unknown_genders_and_titles_are_counted_not_stored(spark, rows):
    raw = spark.createDataFrame(
        [(DAY, "m", "3", "a", 1.0), (DAY, "x", "3", "a", 1.0), (DAY, None, "3", None, 1.0)],
        "period date, gender_code string, age_code string, brand string, ratio double",
    )
    assert rows(plans.labelled(raw), "gender") == [("male",)]
    assert rows(ops.unknown_genders(raw)) == sorted([("x", 1), (None, 1)], key=repr)
    assert rows(ops.unknown_brands(raw, ["a"])) == [(None, 1)]


def raw_trend(spark, days):
    return spark.range(days).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id AS INT)) AS period", "'m' AS gender_code", "'3' AS age_code", "'a' AS brand", "1.0D AS ratio"
    )


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_replaces_all_days_in_any_mode(spark, tmp_path, mode):
    path = str(tmp_path / "share")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for days in (30, 4):
            plans.full_refresh(raw_trend(spark, days), path, BRANDS)
            assert plans.read_share(spark, path).select("period").distinct().count() == days
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [p.name for p in tmp_path.iterdir()] == ["share"]


def test_first_incremental_run_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "share")
    assert plans.incremental(spark, raw_trend(spark, 3), path, date(2024, 1, 2), BRANDS)
    assert plans.read_share(spark, path).select("period").distinct().count() == 2
    assert not plans.incremental(spark, raw_trend(spark, 3), path, date(2024, 1, 2), BRANDS)
    assert plans.incremental(spark, raw_trend(spark, 3), path, date(2024, 1, 3), BRANDS, update=True)
    assert plans.read_share(spark, path).count() == 9
