"""The given tables read as the entities the operators work on, in Spark and as SQL text."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = date(2024, 2, 1)
FOLDER = "media_video_search_daily"
EVENT_BRANDS = ["view", "click", "signup", "purchase", "error"]

class Binding(NamedTuple):
    """A given table and the expressions, valid in both engines, that make an entity of it."""

    table: str
    columns: list[str]


CHANNELS = Binding(
    "customer",
    [
        "CAST(c_custkey AS {text}) AS channel_id",
        "c_name AS channel_title",
        "CAST(floor(c_acctbal * 150) AS BIGINT) AS subscriber_count",
        "CAST(floor(c_acctbal * 3000) AS BIGINT) AS total_views",
        "CAST(c_custkey % 1000 AS BIGINT) AS video_count",
    ],
)

VIDEOS = Binding(
    "orders",
    [
        "CAST(o_orderkey AS {text}) AS video_id",
        "concat('  ', o_orderpriority, ' ', o_orderstatus, ' ') AS title",
        "nullif(o_orderpriority, '5-LOW') AS description",
        "CAST(CAST(o_orderdate AS DATE) AS {text}) AS published_at",
        "CAST(o_custkey AS {text}) AS channel_id",
        "concat('channel ', CAST(o_custkey AS {text})) AS channel_title",
        "CAST(floor(o_totalprice) AS BIGINT) AS view_count",
        "CAST((o_orderkey * 7919) % 5000 AS BIGINT) AS like_count",
        "CAST((o_orderkey * 104729) % 500 - 5 AS BIGINT) AS comment_count",
        "{split}(o_orderpriority, '-') AS tags",
    ],
)

COMMENTS = Binding(
    "documents",
    [
        "CAST(doc_id % 100 AS {text}) AS video_id",
        "source AS author",
        "text AS comment_text",
        "lang AS published_at",
        "CAST(n_chars % 100 AS BIGINT) AS like_count",
    ],
)

TREND = Binding(
    "events",
    [
        "CAST(ts AS DATE) AS period",
        "CASE WHEN user_id % 2 = 0 THEN 'm' ELSE 'f' END AS gender_code",
        "CAST(CAST(floor(user_id / 2) AS BIGINT) % 11 + 1 AS {text}) AS age_code",
        "event_type AS brand",
        "CAST(value AS DECIMAL(18,2)) AS ratio",
    ],
)

TREND_RANKS = Binding("events", [*TREND.columns, "CAST(event_id AS BIGINT) AS rank"])

NEWS = Binding(
    "documents",
    [
        "source",
        "concat('Report ', CAST(doc_id AS {text})) AS title",
        "concat('https://example.org/', CAST(doc_id AS {text})) AS link",
        "text AS summary",
        "'' AS published",
    ],
)

# One file holds every line: the worst case for grouping by file.
LOGS = Binding(
    "events",
    [
        "'scheduler.log' AS file",
        "event_id AS line_no",
        """CASE event_type
         WHEN 'view' THEN ''
         WHEN 'click' THEN concat('free text ', CAST(event_id AS {text}))
         ELSE concat('[', CAST(CAST(ts AS DATE) AS {text}), 'T00:00:00.000+0000] {{taskinstance.py:',
              CAST(event_id % 97 AS {text}), '}} ',
              CASE event_type
                WHEN 'signup' THEN 'INFO - DagRun x was created'
                WHEN 'error' THEN concat('ERROR - Task failed with exception E', CAST(user_id AS {text}))
                ELSE concat('INFO - Marking task as SUCCESS. dag_id=d', CAST(user_id AS {text}),
                     ', task_id=t1, execution_date=a, start_date=b, end_date=c') END) END AS message""",
    ],
)

# Events of more than a thousand lines: a failure with its trace, noise, a state change, over and over.
LONG_LOGS = Binding(
    "events",
    [
        "'worker.log' AS file",
        "event_id AS line_no",
        """CASE CAST(event_id % 4000 AS INTEGER)
         WHEN 0 THEN concat('[', CAST(CAST(ts AS DATE) AS {text}),
              'T00:00:00.000+0000] {{taskinstance.py:7}} ERROR - Task failed with exception E', CAST(user_id AS {text}))
         WHEN 1300 THEN concat('[', CAST(CAST(ts AS DATE) AS {text}),
              'T00:00:00.000+0000] {{dagrun.py:9}} INFO - DagRun x was created')
         WHEN 2600 THEN concat('[', CAST(CAST(ts AS DATE) AS {text}),
              'T00:00:00.000+0000] {{taskinstance.py:8}} INFO - Marking task as SUCCESS. dag_id=d', CAST(user_id AS {text}),
              ', task_id=t1, execution_date=a, start_date=b, end_date=c')
         ELSE concat('  line ', CAST(event_id AS {text}), ' ', event_type) END AS message""",
    ],
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, binding: Binding) -> DataFrame:
    """The entity over the whole table at ``sf_dir``."""
    columns = [c.format(text="STRING", split="split") for c in binding.columns]
    return table(spark, sf_dir, binding.table).selectExpr(*columns)


def sql(binding: Binding) -> str:
    """The same entity as a parenthesised relation of the checking engine."""
    columns = ",\n  ".join(c.format(text="VARCHAR", split="string_split") for c in binding.columns)
    return f"(SELECT {columns} FROM {binding.table})"


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, CHANNELS)


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, VIDEOS)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, COMMENTS)


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, TREND)


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, NEWS)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, LOGS)


# --- the cleaned entities as SQL, shared by the checks ---

D = "DATE '2024-02-01'"

BRONZE_CHANNELS = f"""(
SELECT DISTINCT trim(channel_id, ' ') AS channel_id, trim(channel_title, ' ') AS channel_title,
       subscriber_count, total_views, video_count, {D} AS crawled_date
FROM {sql(CHANNELS)} r
WHERE channel_id IS NOT NULL AND channel_title IS NOT NULL
  AND subscriber_count >= 0 AND total_views >= 0 AND video_count >= 0)"""

BRONZE_VIDEOS = f"""(
SELECT DISTINCT video_id, trim(title, ' ') AS title, trim(description, ' ') AS description, published_at,
       channel_id, channel_title, view_count, like_count, comment_count,
       array_to_string(tags, ',') AS tags, {D} AS crawled_date
FROM {sql(VIDEOS)} r
WHERE title IS NOT NULL AND description IS NOT NULL AND length(trim(title, ' ')) >= 3
  AND view_count >= 0 AND like_count >= 0 AND comment_count >= 0)"""

BRONZE_COMMENTS = f"""(
SELECT DISTINCT video_id, trim(author, ' ') AS author, trim(comment_text, ' ') AS comment_text, published_at,
       like_count, {D} AS crawled_date
FROM {sql(COMMENTS)} r
WHERE comment_text IS NOT NULL AND length(trim(comment_text, ' ')) >= 3 AND like_count >= 0)"""

SILVER_CHANNELS = f"""(
SELECT *, CAST(CASE WHEN subscriber_count > 100000 THEN 1 ELSE 0 END AS INTEGER) AS is_big_channel,
       CASE WHEN subscriber_count > 1000000 THEN 'platinum' WHEN subscriber_count > 100000 THEN 'gold'
            WHEN subscriber_count > 10000 THEN 'silver' ELSE 'bronze' END AS channel_tier
FROM {BRONZE_CHANNELS} b)"""

SILVER_VIDEOS = f"""(
SELECT *, like_count / (view_count + 1.0::DOUBLE) AS like_to_view_ratio,
       comment_count / (view_count + 1.0::DOUBLE) AS comment_to_view_ratio,
       (like_count * 2 + comment_count) / (view_count + 1.0::DOUBLE) AS engagement_score
FROM {BRONZE_VIDEOS} b)"""

AGE_SQL = """CASE age_code WHEN '2' THEN '10대' WHEN '3' THEN '20대' WHEN '4' THEN '20대' WHEN '5' THEN '30대'
  WHEN '6' THEN '30대' WHEN '7' THEN '40대' WHEN '8' THEN '40대' WHEN '9' THEN '50대' WHEN '10' THEN '50대'
  WHEN '11' THEN '60대 이상' END"""

LABELLED = f"""(
SELECT period, CASE gender_code WHEN 'm' THEN 'male' ELSE 'female' END AS gender,
       {AGE_SQL} AS age_group, brand, ratio
FROM {sql(TREND)} t WHERE age_code <> '1')"""


MANY_LABELLED = f"""(
SELECT period, CASE gender_code WHEN 'm' THEN 'male' ELSE 'female' END AS gender, {AGE_SQL} AS age_group,
       concat(brand, CAST(rank % 18 AS VARCHAR)) AS brand, CASE WHEN rank % 7 <> 0 THEN ratio END AS ratio
FROM {sql(TREND_RANKS)} t WHERE age_code <> '1')"""


def share_sql(where: str = "TRUE", brands: list[str] = EVENT_BRANDS, relation: str = LABELLED) -> str:
    """Shares of the labelled trend rows that meet the condition."""
    brands = ", ".join(f"('{b}')" for b in brands)
    return f"""(
WITH l AS (SELECT * FROM {relation} x WHERE {where}),
 cells AS (SELECT DISTINCT period, gender, age_group FROM l),
 sums AS (SELECT period, gender, age_group, brand, sum(ratio) AS v FROM l GROUP BY ALL),
 filled AS (SELECT c.period, c.gender, c.age_group, b.brand, coalesce(s.v, 0) AS v
   FROM cells c CROSS JOIN (VALUES {brands}) b(brand)
   LEFT JOIN sums s ON s.period = c.period AND s.gender = c.gender AND s.age_group = c.age_group AND s.brand = b.brand),
 totals AS (SELECT *, sum(v) OVER (PARTITION BY period, gender, age_group) AS t FROM filled)
SELECT period, gender, age_group, brand, v::DOUBLE AS value,
       CASE WHEN t > 0 THEN floor((v::DOUBLE / t::DOUBLE * 100) * 100 + 0.5) / 100 ELSE v::DOUBLE END AS ratio
FROM totals)"""
