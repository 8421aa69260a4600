from datetime import date

import pytest

from tidemark.plans import medallion
from tidemark.schemas import RAW
from tidemark.sinks import files, tables
from tidemark.sources import snapshots
from tidemark.workdir import fresh_dir, shared_root

DAY = date(2025, 3, 22)


def test_paths():
    folder = snapshots.service_folder("media", "video", "search", "daily")
    assert snapshots.raw_path("/r", DAY, folder, "comments") == "/r/raw/20250322/media_video_search_daily/comments/data.parquet"
    assert snapshots.dump_name("Media", "Trend", "Search", "Daily", DAY) == "Media_Trend_Search_Daily_20250322.parquet"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_partition_replace_and_append(spark, tmp_path, rows):
    path = str(tmp_path / "f")
    one = spark.createDataFrame([(1, DAY)], "v int, feature_date date")
    other = spark.createDataFrame([(2, date(2025, 3, 23))], "v int, feature_date date")
    files.write_partitioned(one, path)
    files.write_partitioned(other, path)
    files.write_partitioned(one, path)
    assert rows(spark.read.parquet(path), "v") == [(1,), (2,)]
    files.write_partitioned(one, path, mode="append")
    assert snapshots.read_feature_day(spark, path, DAY).count() == 2
    with pytest.raises(ValueError):
        files.write_partitioned(one, path, mode="other")


def test_many_days_are_gathered_and_large_ones_may_split(spark, tmp_path, plan):
    many = spark.range(1_000).repartition(8).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 20 AS INT)) AS d")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(files.gathered(many, ["d"]))
    files.write_partitioned(many, str(tmp_path / "f"), ["d"], gather=True)
    assert len(list((tmp_path / "f").glob("d=*/*.parquet"))) == 20


def test_feature_day_prunes_and_keeps_its_column(spark, tmp_path, plan):
    path = str(tmp_path / "f")
    files.write_partitioned(spark.createDataFrame([(1, DAY)], "v int, feature_date date"), path)
    day = snapshots.read_feature_day(spark, path, DAY)
    assert day.first().feature_date == DAY and "PartitionFilters: [isnotnull(feature_date" in plan(day)


def test_csv_export(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.export_csv(spark.range(50).selectExpr("id", "'음료, \"x\"' AS t"), path, rows=10, keys=["id"])
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert snapshots.read_header_csv(spark, path).dtypes == [("id", "string"), ("t", "string")]
    typed = snapshots.read_header_csv(spark, path, "id bigint, t string").orderBy("id").collect()
    assert [r.id for r in typed] == list(range(10)) and len(typed) == 10


def test_dual_export_of_nothing(spark, tmp_path):
    assert not files.dual_export(spark.range(0), str(tmp_path / "p"), str(tmp_path / "c"))
    assert not (tmp_path / "p").exists()


def test_replace_table_switches_to_a_new_version(spark, tmp_path, rows):
    tables.create_namespace(spark, "ns_replace", str(tmp_path / "ns"))
    name = "ns_replace.t"
    tables.replace_table(spark.range(2), name, location=str(tmp_path / "t"))
    tables.replace_table(spark.range(3).selectExpr("id", "'x' AS x"), name, location=str(tmp_path / "t"))
    assert snapshots.read_table(spark, name).count() == 3
    assert rows(tables.describe_table(spark, name)) == [("id", "bigint"), ("x", "string")]
    assert len(list((tmp_path / "t").iterdir())) == 2
    assert [r.id for r in snapshots.table_sample(spark, name, ["id"], 2).collect()] == [0, 1]
    with pytest.raises(ValueError):
        tables.replace_table(spark.range(1), name)
    tables.drop_tables(spark, [name, "ns_replace.missing"])
    assert not tables.table_exists(spark, name)
    tables.drop_namespace(spark, "ns_replace")


def test_share_table_ddl(spark, tmp_path):
    tables.create_namespace(spark, "ns_share", str(tmp_path / "ns"))
    for _ in range(2):
        tables.create_share_table(spark, "ns_share.s")
    assert tables.table_exists(spark, "ns_share.s")
    tables.drop_namespace(spark, "ns_share")
    assert not tables.table_exists(spark, "ns_share.s")


def land(spark, root, folder):
    data = {
        "channel_info": [("c1", " big ", 2_000_000, 10, 1), ("c2", "bad", -1, 0, 0)],
        "video_info": [
            ("v1", "first video", "d", "p", "c1", "big", 9, 1, 1, ["t"]),
            ("v2", "second video", "d", "p", "c2", "bad", 9, 1, 1, []),
        ],
        "comments": [("v1", "a", "good one", "p", 5)],
    }
    for entity, entity_rows in data.items():
        spark.createDataFrame(entity_rows, RAW[entity]).write.parquet(snapshots.raw_path(root, DAY, folder, entity))


def test_medallion(spark, tmp_path, rows):
    root, lake, folder = str(tmp_path / "raw"), str(tmp_path / "lake"), "media_test_daily"
    land(spark, root, folder)
    store = str(tmp_path / "store")
    files.publish_snapshot(spark, root, store, DAY, folder, RAW)
    features = str(tmp_path / "features")
    for _ in range(2):
        report = medallion.run_medallion(spark, store, lake, folder, features, DAY, min_rows=1)
    assert rows(report, "table_name", "status") == [
        ("channel_info", "PASS"), ("comments_info", "PASS"), ("video_info", "PASS"),
    ]
    got = spark.read.parquet(features)
    assert rows(got, "channel_tier", "feature_date") == [("platinum", DAY), (None, DAY)]
    silver = snapshots.read_table(spark, f"{folder}_silver.comments_feature").first()
    assert (silver.comment_length, silver.sentiment_flag, silver.feature_date) == (8, 1, DAY)
    medallion.export_silver(spark, folder, "video_feature", ["video_id"], str(tmp_path / "x"), rows=None)
    assert snapshots.read_header_csv(spark, str(tmp_path / "x")).count() == 2
    with pytest.raises(ValueError):
        medallion.run_medallion(spark, store, lake, folder, features, DAY, fail_on_issue=True)
    medallion.write_standard_record(spark, str(tmp_path / "standard"))
    assert snapshots.read_header_csv(spark, str(tmp_path / "standard")).first().channel_tier == "gold"
    for layer in ("bronze", "silver"):
        tables.drop_namespace(spark, f"{folder}_{layer}")
        assert not (tmp_path / "lake" / f"{folder}_{layer}").exists()


def test_csv_keeps_texts_as_they_are(spark, tmp_path, rows):
    texts = ["", None, " a ", "x\ny", "x\r\ny", 'say "hi", \\ ok', "\t", '"', '""', "ende\n"]
    df = spark.createDataFrame([(i, t, ["p", "q"]) for i, t in enumerate(texts)], "id bigint, t string, tags array<string>")
    files.export_csv(df, str(tmp_path / "all"), rows=None)
    back = snapshots.read_header_csv(spark, str(tmp_path / "all"), files.flat(df).schema)
    assert rows(back) == rows(files.flat(df))
    with pytest.raises(ValueError):
        files.export_csv(df, str(tmp_path / "some"), rows=3)


def test_dumps_are_in_key_order_across_files(spark, tmp_path):
    # Partitions of uneven size: reading them back by size would change their order.
    df = spark.range(40_000).selectExpr("id", "CASE WHEN id < 10000 THEN repeat('x', 300) ELSE 'y' END AS t").orderBy("id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert files.dual_export(df, str(tmp_path / "p"), str(tmp_path / "c"), ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "c").glob("part-*.csv"))
    numbers = [int(line.split(",")[0]) for part in parts for line in part.read_text().splitlines()[1:]]
    assert len(parts) > 1 and numbers == list(range(40_000))


def test_same_columns_switch_in_one_step(spark, tmp_path):
    tables.create_namespace(spark, "ns_switch", str(tmp_path / "ns"))
    for n in (2, 3):
        tables.replace_table(spark.range(n), "ns_switch.t", location=str(tmp_path / "t"))
        assert spark.table("ns_switch.t").count() == n
    tables.replace_table(spark.range(4).selectExpr("id AS other"), "ns_switch.t", location=str(tmp_path / "t"))
    assert spark.table("ns_switch.t").columns == ["other"]
    assert [t.name for t in spark.catalog.listTables("ns_switch")] == ["t"]
    tables.drop_namespace(spark, "ns_switch")
