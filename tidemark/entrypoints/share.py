"""Registered queries: search shares, watermarks, merges, table definitions."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tidemark.entrypoints import bindings as b
from tidemark.fixed_values import FIRST_PERIOD
from tidemark.functions.columns import document_id
from tidemark.operators import merge
from tidemark.operators import share as ops
from tidemark.plans import share as plans
from tidemark.schemas import SHARE_KEYS
from tidemark.sinks import files, tables
from tidemark.sources import landing, relational, snapshots
from tidemark.workdir import fresh_dir

LAST_LOADED = date(2024, 1, 20)
RESTATED_FROM = date(2024, 1, 18)
STAMP = datetime(2024, 2, 1)
MANY_BRANDS = [f"{brand}{i}" for brand in b.EVENT_BRANDS for i in range(18)]


def _labelled(spark, sf):
    return plans.labelled(b.trend(spark, sf))


def _shares(spark, sf):
    return ops.normalise(_labelled(spark, sf), b.EVENT_BRANDS)


def _loaded(spark, sf):
    """Shares of the days up to the last load."""
    return _shares(spark, sf).where(F.col("period") <= F.lit(LAST_LOADED))


def _restated(spark, sf):
    """Shares of the later days, three of them already loaded and now changed; every row comes twice."""
    later = _shares(spark, sf).where(F.col("period") >= F.lit(RESTATED_FROM))
    return later.withColumn("ratio", F.explode(F.array(F.col("ratio") + 1.0, F.col("ratio") + 2.0)))


def trend_json_flatten(spark, sf):
    entries = F.array(F.struct(F.col("period").cast("string").alias("period"), F.col("ratio").cast("double").alias("ratio")))
    results = F.array(
        F.struct(F.col("brand").alias("title"), entries.alias("data")),
        F.struct(F.lit("no data").alias("title"), F.slice(entries, 1, 0).alias("data")),
    )
    responses = b.trend(spark, sf).select(
        "gender_code", "age_code", F.to_json(F.struct(results.alias("results"))).alias("response")
    )
    return landing.flatten_trend(responses)


def share_union_cells(spark, sf):
    trend = b.trend(spark, sf)
    return ops.union_cells([ops.gender_part(trend, "m"), ops.gender_part(trend, "f")])


def share_full_refresh(spark, sf):
    path = fresh_dir(spark, "share")
    plans.full_refresh(b.trend(spark, sf), path, b.EVENT_BRANDS, STAMP)
    return plans.read_share(spark, path).drop("updated_at")


def _loaded_table(spark, sf):
    path = fresh_dir(spark, "share")
    trend = b.trend(spark, sf).where(F.col("period") <= F.lit(LAST_LOADED))
    plans.full_refresh(trend, path, b.EVENT_BRANDS, STAMP)
    return path


def share_incremental(spark, sf):
    """Loads the days after the table's last one, twice: the second run finds nothing to do."""
    path = _loaded_table(spark, sf)
    for _ in range(2):
        plans.incremental(spark, b.trend(spark, sf), path, b.RUN_DATE, b.EVENT_BRANDS, run_ts=STAMP)
    return plans.read_share(spark, path).drop("updated_at")


def share_first_run(spark, sf):
    """An incremental load where there is no table yet: it starts with the default day."""
    path = fresh_dir(spark, "share")
    trend = b.trend(spark, sf)
    for _ in range(2):
        plans.incremental(spark, trend, path, b.RUN_DATE, b.EVENT_BRANDS, run_ts=STAMP)
    return plans.read_share(spark, path).drop("updated_at")


def _many_brands(spark, sf):
    """Ninety brands, and ratios that are missing."""
    brand = F.concat("brand", F.pmod(F.col("rank"), F.lit(18)).cast("string"))
    rows = b.bind(spark, sf, b.TREND_RANKS).withColumn("brand", brand)
    return plans.labelled(rows.withColumn("ratio", F.when(F.col("rank") % 7 != 0, F.col("ratio"))).drop("rank"))


def share_table_upsert(spark, sf):
    """Restated shares into the stored table: touched days are rebuilt, the others stay as they are."""
    path = _loaded_table(spark, sf)
    source = merge.stamp(_restated(spark, sf), STAMP)
    files.upsert_partitions(spark, path, source, SHARE_KEYS, order_by=["ratio"])
    return plans.read_share(spark, path).drop("updated_at")


def incremental_slice(spark, sf):
    start = ops.next_start(_loaded(spark, sf))
    return ops.incremental_slice(b.trend(spark, sf), start, b.RUN_DATE)


def upsert_by_key(spark, sf):
    rows = merge.upsert_by_key(_loaded(spark, sf), _restated(spark, sf), SHARE_KEYS, ["ratio"])
    return rows.withColumn("doc_id", document_id(SHARE_KEYS))


def upsert_stamped(spark, sf):
    """The upsert with the moment of the run on every row: untouched rows keep theirs."""
    loaded, restated = merge.stamp(_loaded(spark, sf), STAMPS[0]), merge.stamp(_restated(spark, sf), STAMPS[1])
    rows = merge.upsert_by_key(loaded, restated, SHARE_KEYS, ["ratio"])
    return rows.select(*SHARE_KEYS, "ratio", F.unix_seconds("updated_at").alias("updated_epoch"))


def ordered_share_scan(spark, sf):
    return relational.ordered_share(plans.read_share(spark, _loaded_table(spark, sf))).drop("updated_at")


def share_dump(spark, sf):
    """The stored table as an ordered dump in both formats, the Parquet one published."""
    root = fresh_dir(spark, "dump")
    plans.dump_share(spark, _loaded_table(spark, sf), f"{root}/parquet", f"{root}/csv")
    name = snapshots.dump_name("Media", "Trend", "Search", "Daily", b.RUN_DATE)
    published = plans.publish_dump(spark, f"{root}/parquet", root, name)
    parquet = spark.read.parquet(published).drop("updated_at").withColumn("fmt", F.lit("parquet"))
    csv = snapshots.read_header_csv(spark, f"{root}/csv", plans.SHARE).drop("updated_at")
    return parquet.unionByName(csv.withColumn("fmt", F.lit("csv")))


def ddl_roundtrip(spark, sf):
    """Namespace and share table from creation to removal, with the whole trend's shares in between."""
    root = fresh_dir(spark, "ddl")
    namespace = "tidemark_" + root[-32:]
    name = f"{namespace}.search_share"
    tables.create_namespace(spark, namespace, root)
    existed = tables.table_exists(spark, name)
    tables.create_share_table(spark, name)
    tables.create_share_table(spark, name)
    rows = merge.stamp(_shares(spark, sf), STAMP)
    rows.select(*spark.table(name).columns).write.insertInto(name)
    loaded = spark.table(name).count()
    found = tables.table_exists(spark, name)
    tables.drop_tables(spark, [name], purge=True)
    left = tables.table_exists(spark, name)
    tables.drop_namespace(spark, namespace)
    steps = [("existed", int(existed)), ("found", int(found)), ("rows", loaded), ("left", int(left))]
    return spark.createDataFrame(steps, "step string, n bigint")


ALL_SHARES = b.share_sql()
LOADED_SHARES = b.share_sql("period <= DATE '2024-01-20'")
LATER_SHARES = b.share_sql("period >= DATE '2024-01-18'")
MANY_SHARES = b.share_sql(brands=MANY_BRANDS, relation=b.MANY_LABELLED)
FIRST_SHARES = b.share_sql(f"period >= DATE '{FIRST_PERIOD}'")
KEYS = "period, gender, age_group, brand"
SAME_KEY = "t.period = s.period AND t.gender = s.gender AND t.age_group = s.age_group AND t.brand = s.brand"
STAMPS = [datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, 12, tzinfo=timezone.utc)]
UPSERTED = f"""(
SELECT {KEYS}, ratio FROM {LOADED_SHARES} t WHERE NOT EXISTS (SELECT 1 FROM {LATER_SHARES} s WHERE {SAME_KEY})
UNION ALL SELECT {KEYS}, ratio + 2.0 FROM {LATER_SHARES} s)"""

def inline_dims(spark, sf):
    """The age-code relation with the trend rows of each code."""
    observed = b.trend(spark, sf).groupBy("age_code").agg(F.count(F.lit(1)).alias("trend_rows"))
    return observed.join(F.broadcast(ops.age_dim(spark)), "age_code")


QUERIES = {
    "inline_dims": inline_dims,
    "trend_json_flatten": trend_json_flatten,
    "age_group_map": lambda s, d: ops.map_age_groups(b.trend(s, d)).withColumn("ratio", F.col("ratio").cast("double")),
    "share_union_cells": lambda s, d: share_union_cells(s, d).withColumn("ratio", F.col("ratio").cast("double")),
    "share_zero_fill": lambda s, d: ops.zero_fill(_labelled(s, d), b.EVENT_BRANDS),
    "share_normalise": _shares,
    "share_many_brands": lambda s, d: ops.normalise(_many_brands(s, d), MANY_BRANDS),
    "share_many_brands_fill": lambda s, d: ops.zero_fill(_many_brands(s, d), [*MANY_BRANDS, *MANY_BRANDS[:3]]),
    "unknown_brands": lambda s, d: ops.unknown_brands(b.trend(s, d), ["view", "click"]),
    "share_full_refresh": share_full_refresh,
    "share_incremental": share_incremental,
    "share_first_run": share_first_run,
    "share_table_upsert": share_table_upsert,
    "high_watermark": lambda s, d: relational.high_watermark(b.trend(s, d), date.fromisoformat(FIRST_PERIOD)),
    "latest_period_top1": lambda s, d: relational.latest_period(b.trend(s, d)),
    "incremental_slice": lambda s, d: incremental_slice(s, d).withColumn("ratio", F.col("ratio").cast("double")),
    "insert_ignore": lambda s, d: merge.insert_ignore(_loaded(s, d), _restated(s, d), SHARE_KEYS, ["ratio"]),
    "upsert_by_key": upsert_by_key,
    "upsert_stamped": upsert_stamped,
    "ordered_share_scan": ordered_share_scan,
    "share_dump": share_dump,
    "ddl_roundtrip": ddl_roundtrip,
}

ORACLE = {
    "inline_dims": f"""SELECT age_code, count(*) AS trend_rows, {b.AGE_SQL} AS age_group
FROM {b.sql(b.TREND)} t WHERE age_code <> '1' GROUP BY age_code""",
    "trend_json_flatten": f"SELECT gender_code, age_code, period, brand, ratio::DOUBLE AS ratio FROM {b.sql(b.TREND)} t",
    "age_group_map": f"""SELECT period, gender_code, brand, ratio::DOUBLE AS ratio, {b.AGE_SQL} AS age_group
FROM {b.sql(b.TREND)} t WHERE age_code <> '1'""",
    "share_union_cells": f"""SELECT period, CASE gender_code WHEN 'm' THEN 'male' ELSE 'female' END AS gender,
  age_code, brand, ratio::DOUBLE AS ratio FROM {b.sql(b.TREND)} t""",
    "share_zero_fill": f"SELECT {KEYS}, value AS ratio FROM {ALL_SHARES} s",
    "share_normalise": f"SELECT {KEYS}, ratio FROM {ALL_SHARES} s",
    "share_many_brands": f"SELECT {KEYS}, ratio FROM {MANY_SHARES} s",
    "share_many_brands_fill": f"SELECT {KEYS}, value AS ratio FROM {MANY_SHARES} s",
    "unknown_brands": f"""SELECT brand, count(*) AS rows FROM {b.sql(b.TREND)} t
WHERE brand NOT IN ('view', 'click') GROUP BY brand""",
    "share_full_refresh": f"SELECT {KEYS}, ratio FROM {ALL_SHARES} s",
    "share_incremental": f"SELECT {KEYS}, ratio FROM {ALL_SHARES} s",
    "share_first_run": f"SELECT {KEYS}, ratio FROM {FIRST_SHARES} s",
    "share_table_upsert": f"SELECT * FROM {UPSERTED} u",
    "high_watermark": "SELECT CAST(max(ts) AS DATE) AS period FROM events",
    "latest_period_top1": "SELECT CAST(ts AS DATE) AS period FROM events ORDER BY ts DESC LIMIT 1",
    "incremental_slice": f"""SELECT period, gender_code, age_code, brand, ratio::DOUBLE AS ratio
FROM {b.sql(b.TREND)} t WHERE period > DATE '2024-01-20'""",
    "insert_ignore": f"""
SELECT {KEYS}, ratio FROM {LOADED_SHARES} t
UNION ALL SELECT {KEYS}, ratio + 1.0 FROM {LATER_SHARES} s
WHERE NOT EXISTS (SELECT 1 FROM {LOADED_SHARES} t WHERE {SAME_KEY})""",
    "upsert_by_key": f"""SELECT *, concat_ws('_', CAST(period AS VARCHAR), gender, age_group, brand) AS doc_id
FROM {UPSERTED} u""",
    "upsert_stamped": f"""SELECT u.*, CASE WHEN EXISTS (SELECT 1 FROM {LATER_SHARES} s WHERE {SAME_KEY.replace("t.", "u.")})
  THEN {int(STAMPS[1].timestamp())} ELSE {int(STAMPS[0].timestamp())} END::BIGINT AS updated_epoch FROM {UPSERTED} u""",
    "ordered_share_scan": f"SELECT {KEYS}, ratio FROM {LOADED_SHARES} s ORDER BY {KEYS}",
    "share_dump": f"""SELECT {KEYS}, ratio, 'parquet' AS fmt FROM {LOADED_SHARES} s
UNION ALL SELECT {KEYS}, ratio, 'csv' FROM {LOADED_SHARES} s""",
    "ddl_roundtrip": f"""SELECT * FROM (VALUES ('existed', 0), ('found', 1), ('left', 0)) v(step, n)
UNION ALL SELECT 'rows', count(*) FROM {ALL_SHARES} s""",
}
