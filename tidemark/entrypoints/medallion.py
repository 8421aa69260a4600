"""Registered queries: cleaning, features, quality."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.entrypoints import bindings as b
from tidemark.operators import cleaning, features, quality
from tidemark.plans import medallion
from tidemark.sinks import files, tables
from tidemark.sources import snapshots
from tidemark.workdir import fresh_dir

COUNTERS = {"subscriber_count": ">= 0", "total_views": ">= 0", "video_count": ">= 0"}
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_NULLS = ["l_returnflag", "l_linestatus", "l_shipdate"]


def _bronze_channels(spark, sf):
    return cleaning.bronze_channels(b.channels(spark, sf), b.RUN_DATE)


def _bronze_videos(spark, sf):
    return cleaning.bronze_videos(b.videos(spark, sf), b.RUN_DATE)


def _bronze_comments(spark, sf):
    return cleaning.bronze_comments(b.comments(spark, sf), b.RUN_DATE)


def _lines_with_nulls(spark, sf):
    return b.table(spark, sf, "lineitem").withColumn(
        "l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("A"))
    )


def _features(spark, sf, **options):
    videos = features.video_features(_bronze_videos(spark, sf))
    channels = features.channel_features(_bronze_channels(spark, sf))
    return features.training_features(videos, channels, b.RUN_DATE, **options)


def _landed(spark, sf):
    """Raw snapshots of the three entities below a new root."""
    root = fresh_dir(spark, "raw")
    for entity, rows in (("channel_info", b.channels), ("video_info", b.videos), ("comments", b.comments)):
        rows(spark, sf).write.parquet(snapshots.raw_path(root, b.RUN_DATE, b.FOLDER, entity))
    return root


def scan_raw_snapshot(spark, sf):
    root = fresh_dir(spark, "raw")
    b.videos(spark, sf).write.parquet(snapshots.raw_path(root, b.RUN_DATE, b.FOLDER, "video_info"))
    return snapshots.read_raw(spark, root, b.RUN_DATE, b.FOLDER, "video_info").withColumn(
        "tags", F.concat_ws(",", "tags")
    )


def scan_feature_csv(spark, sf):
    path = fresh_dir(spark, "csv")
    rows = features.channel_features(b.channels(spark, sf))
    files.as_csv(rows).csv(path)
    return snapshots.read_header_csv(spark, path, rows.schema)


def _saved_channels(spark, sf, name):
    root = fresh_dir(spark, "tables")
    namespace = "tidemark_" + root[-32:]
    tables.create_namespace(spark, namespace, root)
    tables.replace_table(b.channels(spark, sf), f"{namespace}.{name}", location=f"{root}/{name}")
    return f"{namespace}.{name}"


def scan_catalog_table(spark, sf):
    return snapshots.read_table(spark, _saved_channels(spark, sf, "channel_info"))


def sql_table_sample(spark, sf):
    return snapshots.table_sample(spark, _saved_channels(spark, sf, "channel_info"), ["channel_id"], 1000)


def describe_table(spark, sf):
    return tables.describe_table(spark, _saved_channels(spark, sf, "channel_info"))


def write_replace_table(spark, sf):
    """Replaces a table by one of another schema and reads the new version."""
    name = _saved_channels(spark, sf, "channel_feature")
    location = fresh_dir(spark, "versions")
    rows = features.with_feature_date(features.channel_features(b.channels(spark, sf)), b.RUN_DATE)
    tables.replace_table(rows, name, location=location)
    return snapshots.read_table(spark, name)


def feature_partition_scan(spark, sf):
    path = fresh_dir(spark, "features")
    videos = features.video_features(b.videos(spark, sf)).drop("tags")
    by_year = videos.withColumn("feature_date", F.trunc(F.to_date("published_at"), "year"))
    files.write_partitioned(by_year, path, gather=True)
    return snapshots.read_feature_day(spark, path, date(1998, 1, 1))


def write_partitioned(spark, sf):
    """Two runs of the same day: the second replaces the first."""
    path = fresh_dir(spark, "features")
    rows = features.with_feature_date(features.channel_features(b.channels(spark, sf)), b.RUN_DATE)
    files.write_partitioned(rows, path)
    files.write_partitioned(rows, path)
    return spark.read.parquet(path)


def export_csv(spark, sf):
    path = fresh_dir(spark, "export")
    rows = features.channel_features(b.channels(spark, sf))
    files.export_csv(rows, path, rows=1000, keys=["channel_id"])
    return snapshots.read_header_csv(spark, path, rows.schema)


def dual_export(spark, sf):
    root = fresh_dir(spark, "dump")
    rows = b.channels(spark, sf)
    files.dual_export(rows, f"{root}/parquet", f"{root}/csv")
    parquet = spark.read.schema(rows.schema).parquet(f"{root}/parquet")
    csv = snapshots.read_header_csv(spark, f"{root}/csv", rows.schema)
    return parquet.withColumn("fmt", F.lit("parquet")).unionByName(csv.withColumn("fmt", F.lit("csv")))


def publish_snapshot(spark, sf):
    source, target = fresh_dir(spark, "local"), fresh_dir(spark, "store")
    b.channels(spark, sf).write.parquet(snapshots.raw_path(source, b.RUN_DATE, b.FOLDER, "channel_info"))
    files.publish_snapshot(spark, source, target, b.RUN_DATE, b.FOLDER, ["channel_info"])
    return snapshots.read_raw(spark, target, b.RUN_DATE, b.FOLDER, "channel_info")


def _medallion(spark, sf):
    """Raw files through every table of the batch; the quality report and the training features."""
    root = fresh_dir(spark, "lake")
    tables_as = f"{b.FOLDER}_{root[-32:]}"
    report = medallion.run_medallion(
        spark, _landed(spark, sf), root, b.FOLDER, f"{root}/features", b.RUN_DATE, tables=tables_as
    )
    return report, spark.read.parquet(f"{root}/features")


def run_medallion(spark, sf):
    return _medallion(spark, sf)[1]


def run_medallion_report(spark, sf):
    return _medallion(spark, sf)[0]


def _channels_with_faults(spark, sf):
    """A tenth of the titles is missing."""
    return _bronze_channels(spark, sf).withColumn(
        "channel_title", F.when(F.col("video_count") % 10 != 0, F.col("channel_title"))
    )


def _videos_with_faults(spark, sf):
    """Some videos come twice, with other counts."""
    videos = _bronze_videos(spark, sf)
    return videos.union(videos.where("like_count < 200").withColumn("view_count", F.col("view_count") + 1))


def comments_csv(spark, sf):
    """Texts with line breaks and quotes, as CSV and read back."""
    path = fresh_dir(spark, "csv")
    rows = b.comments(spark, sf).withColumn("comment_text", F.concat(F.lit(' "'), "comment_text", F.lit('",\r\n ')))
    files.export_csv(rows, path, rows=None)
    return snapshots.read_header_csv(spark, path, rows.schema)


def videos_csv(spark, sf):
    """Rows with an array, as Parquet and CSV; the CSV read back."""
    root = fresh_dir(spark, "dump")
    rows = b.videos(spark, sf)
    files.dual_export(rows, f"{root}/parquet", f"{root}/csv", ["video_id"])
    return snapshots.read_header_csv(spark, f"{root}/csv", files.flat(rows).schema)


CHANNEL_COLUMNS = "channel_id, channel_title, subscriber_count, total_views, video_count"
FEATURE_SQL = f"""
SELECT v.view_count, v.like_count AS like_count_video, v.like_to_view_ratio, v.comment_to_view_ratio,
       v.engagement_score, c.subscriber_count, c.total_views, c.video_count, c.is_big_channel, c.channel_tier,
       {b.D} AS feature_date
FROM {b.SILVER_VIDEOS} v LEFT JOIN {b.SILVER_CHANNELS} c ON v.channel_id = c.channel_id"""
CHANNEL_FEATURES = f"""
SELECT *, CAST(CASE WHEN subscriber_count > 100000 THEN 1 ELSE 0 END AS INTEGER) AS is_big_channel,
       CASE WHEN subscriber_count > 1000000 THEN 'platinum' WHEN subscriber_count > 100000 THEN 'gold'
            WHEN subscriber_count > 10000 THEN 'silver' ELSE 'bronze' END AS channel_tier
FROM {b.sql(b.CHANNELS)} r"""
VIDEO_COLUMNS = """video_id, title, description, published_at, channel_id, channel_title,
  view_count, like_count, comment_count"""
QUALITY_SQL = """SELECT '{table}' AS table_name,
  CASE WHEN null_a > 0.05 OR null_b > 0.05 OR dups > 0 OR total < 1000 THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN null_a > 0.05 AND null_b > 0.05 THEN format('{a}: {{:.1f}}% {c}: {{:.1f}}%', null_a * 100, null_b * 100)
       WHEN null_a > 0.05 THEN format('{a}: {{:.1f}}%', null_a * 100)
       WHEN null_b > 0.05 THEN format('{c}: {{:.1f}}%', null_b * 100) ELSE '없음' END AS null_issues,
  CASE WHEN dups > 0 THEN concat(dups, '건 중복') ELSE '없음' END AS dup_issues,
  CASE WHEN total < 1000 THEN concat(total, '건 < 1000 기준') ELSE '충족' END AS row_issue
FROM (SELECT count(*) AS total, count(*) FILTER (n > 1) AS dummy FROM (SELECT 1 AS n, * FROM {rel} q) z) t,
     (SELECT coalesce(avg(CASE WHEN {a} IS NULL THEN 1.0 ELSE 0.0 END), 0) AS null_a,
             coalesce(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 0) AS null_b FROM {rel} q) n,
     (SELECT count(*) AS dups FROM (SELECT {a} FROM {rel} q GROUP BY {a} HAVING count(*) > 1) g) d"""
COMMENT_ID = "sha256(concat_ws('||', video_id, author, published_at, comment_text))"
COMMENTS_WITH_ID = f"(SELECT *, {COMMENT_ID} AS comment_id FROM {b.BRONZE_COMMENTS} i)"
FAULTY_CHANNELS = f"""(SELECT * REPLACE (CASE WHEN video_count % 10 <> 0 THEN channel_title END AS channel_title)
FROM {b.BRONZE_CHANNELS} i)"""
FAULTY_VIDEOS = f"""(SELECT * FROM {b.BRONZE_VIDEOS} i
UNION ALL SELECT * REPLACE (view_count + 1 AS view_count) FROM {b.BRONZE_VIDEOS} i WHERE like_count < 200)"""


def _report_sql(channels, videos):
    return "\nUNION ALL\n".join(
        QUALITY_SQL.format(table=t, a=a, c=c, rel=rel)
        for t, a, c, rel in (
            ("channel_info", "channel_id", "channel_title", channels),
            ("video_info", "video_id", "title", videos),
            ("comments_info", "comment_id", "comment_text", COMMENTS_WITH_ID),
        )
    )


LINES_SQL = "(SELECT *, nullif(l_returnflag, 'A') AS flag FROM lineitem)"

QUERIES = {
    "scan_raw_snapshot": scan_raw_snapshot,
    "scan_feature_csv": scan_feature_csv,
    "scan_catalog_table": scan_catalog_table,
    "sql_table_sample": sql_table_sample,
    "feature_partition_scan": feature_partition_scan,
    "preview_topn": lambda s, d: snapshots.preview(b.channels(s, d), ["channel_id"], 20),
    "clean_strings": lambda s, d: cleaning.clean_strings(b.videos(s, d)),
    "drop_nulls_any": lambda s, d: cleaning.drop_nulls(cleaning.clean_strings(b.videos(s, d))),
    "dedup_rows": lambda s, d: cleaning.dedup_rows(
        b.table(s, d, "lineitem").union(b.table(s, d, "lineitem").where("l_orderkey % 2 = 0"))
    ),
    "remove_outliers": lambda s, d: cleaning.remove_outliers(b.channels(s, d), COUNTERS),
    "remove_short_text": lambda s, d: cleaning.remove_short_text(
        b.comments(s, d), "comment_text", min_length=200
    ),
    "add_run_date": lambda s, d: cleaning.add_run_date(b.channels(s, d), b.RUN_DATE),
    "bronze_channel": _bronze_channels,
    "bronze_video": _bronze_videos,
    "bronze_comments": _bronze_comments,
    "channel_features": lambda s, d: features.channel_features(_bronze_channels(s, d)),
    "video_features": lambda s, d: features.video_features(_bronze_videos(s, d)),
    "comment_features": lambda s, d: features.comment_features(_bronze_comments(s, d), "tion|good"),
    "feature_join": _features,
    "feature_join_salted": lambda s, d: _features(s, d, salted=True),
    "dq_row_count": lambda s, d: quality.row_count(b.table(s, d, "lineitem")),
    "dq_null_ratio": lambda s, d: quality.null_ratio(_lines_with_nulls(s, d), LINE_NULLS),
    "dq_duplicate_keys": lambda s, d: quality.duplicate_keys(b.table(s, d, "lineitem"), LINE_KEY),
    "quality_report": lambda s, d: quality.quality_report(
        _bronze_channels(s, d), _bronze_videos(s, d), _bronze_comments(s, d)
    ),
    "quality_report_faults": lambda s, d: quality.quality_report(
        _channels_with_faults(s, d), _videos_with_faults(s, d), _bronze_comments(s, d)
    ),
    "comment_id_sha2": lambda s, d: quality.with_comment_id(b.comments(s, d)),
    "write_replace_table": write_replace_table,
    "write_partitioned": write_partitioned,
    "export_csv": export_csv,
    "dual_export": dual_export,
    "publish_snapshot": publish_snapshot,
    "describe_table": describe_table,
    "run_medallion": run_medallion,
    "run_medallion_report": run_medallion_report,
    "comments_csv": comments_csv,
    "videos_csv": videos_csv,
}

ORACLE = {
    "scan_raw_snapshot": f"SELECT * REPLACE (array_to_string(tags, ',') AS tags) FROM {b.sql(b.VIDEOS)} r",
    "scan_feature_csv": CHANNEL_FEATURES,
    "scan_catalog_table": f"SELECT * FROM {b.sql(b.CHANNELS)} r",
    "sql_table_sample": f"SELECT * FROM {b.sql(b.CHANNELS)} r ORDER BY channel_id LIMIT 1000",
    "feature_partition_scan": f"""
SELECT {VIDEO_COLUMNS}, like_count / (view_count + 1.0::DOUBLE) AS like_to_view_ratio,
  comment_count / (view_count + 1.0::DOUBLE) AS comment_to_view_ratio,
  (like_count * 2 + comment_count) / (view_count + 1.0::DOUBLE) AS engagement_score, DATE '1998-01-01' AS feature_date
FROM {b.sql(b.VIDEOS)} r WHERE year(CAST(published_at AS DATE)) = 1998""",
    "preview_topn": f"SELECT * FROM {b.sql(b.CHANNELS)} r ORDER BY channel_id LIMIT 20",
    "clean_strings": f"""SELECT * REPLACE (trim(title, ' ') AS title, trim(description, ' ') AS description,
  array_to_string(tags, ',') AS tags) FROM {b.sql(b.VIDEOS)} r""",
    "drop_nulls_any": f"""SELECT * REPLACE (trim(title, ' ') AS title, trim(description, ' ') AS description,
  array_to_string(tags, ',') AS tags) FROM {b.sql(b.VIDEOS)} r WHERE description IS NOT NULL""",
    "dedup_rows": "SELECT DISTINCT * FROM lineitem",
    "remove_outliers": f"""SELECT * FROM {b.sql(b.CHANNELS)} r
WHERE subscriber_count >= 0 AND total_views >= 0 AND video_count >= 0""",
    "remove_short_text": f"SELECT * FROM {b.sql(b.COMMENTS)} r WHERE length(comment_text) >= 200",
    "add_run_date": f"SELECT *, {b.D} AS crawled_date FROM {b.sql(b.CHANNELS)} r",
    "bronze_channel": f"SELECT * FROM {b.BRONZE_CHANNELS} r",
    "bronze_video": f"SELECT * FROM {b.BRONZE_VIDEOS} r",
    "bronze_comments": f"SELECT * FROM {b.BRONZE_COMMENTS} r",
    "channel_features": f"SELECT * FROM {b.SILVER_CHANNELS} r",
    "video_features": f"SELECT * FROM {b.SILVER_VIDEOS} r",
    "comment_features": f"""SELECT *, CAST(length(comment_text) AS INTEGER) AS comment_length,
  CAST(CASE WHEN like_count > 50 AND length(comment_text) > 20 THEN 1 ELSE 0 END AS INTEGER) AS is_highlighted,
  CAST(CASE WHEN regexp_matches(comment_text, 'tion|good') THEN 1 ELSE 0 END AS INTEGER) AS sentiment_flag
FROM {b.BRONZE_COMMENTS} r""",
    "feature_join": FEATURE_SQL,
    "feature_join_salted": FEATURE_SQL,
    "dq_row_count": "SELECT count(*) AS total FROM lineitem",
    "dq_null_ratio": f"""
SELECT column_name, null_count, total, null_count::DOUBLE / total AS null_ratio,
  null_count::DOUBLE / total > 0.05 AS is_issue
FROM (SELECT 'l_returnflag' AS column_name, count(*) FILTER (flag IS NULL) AS null_count, count(*) AS total FROM {LINES_SQL} a
  UNION ALL SELECT 'l_linestatus', count(*) FILTER (l_linestatus IS NULL), count(*) FROM {LINES_SQL} a
  UNION ALL SELECT 'l_shipdate', count(*) FILTER (l_shipdate IS NULL), count(*) FROM {LINES_SQL} a) u""",
    "dq_duplicate_keys": """SELECT count(*) AS duplicate_keys FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) g""",
    "quality_report": _report_sql(b.BRONZE_CHANNELS, b.BRONZE_VIDEOS),
    "quality_report_faults": _report_sql(FAULTY_CHANNELS, FAULTY_VIDEOS),
    "run_medallion_report": _report_sql(b.BRONZE_CHANNELS, b.BRONZE_VIDEOS),
    "comments_csv": f"""SELECT * REPLACE (' "' || comment_text || '",' || chr(13) || chr(10) || ' ' AS comment_text)
FROM {b.sql(b.COMMENTS)} r""",
    "videos_csv": f"SELECT * REPLACE (array_to_string(tags, ',') AS tags) FROM {b.sql(b.VIDEOS)} r",
    "comment_id_sha2": f"SELECT *, {COMMENT_ID} AS comment_id FROM {b.sql(b.COMMENTS)} r",
    "write_replace_table": f"SELECT *, {b.D} AS feature_date FROM ({CHANNEL_FEATURES}) f",
    "write_partitioned": f"SELECT *, {b.D} AS feature_date FROM ({CHANNEL_FEATURES}) f",
    "export_csv": f"SELECT * FROM ({CHANNEL_FEATURES}) f ORDER BY channel_id LIMIT 1000",
    "dual_export": f"""SELECT *, 'parquet' AS fmt FROM {b.sql(b.CHANNELS)} r
UNION ALL SELECT *, 'csv' AS fmt FROM {b.sql(b.CHANNELS)} r""",
    "publish_snapshot": f"SELECT * FROM {b.sql(b.CHANNELS)} r",
    "describe_table": f"""SELECT column_name AS col_name,
  CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT * FROM {b.sql(b.CHANNELS)} r)""",
    "run_medallion": FEATURE_SQL,
}
