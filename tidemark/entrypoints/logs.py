"""Registered queries: scheduler logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entrypoints import bindings as b
from tidemark.operators import logs as ops
from tidemark.plans import logs as plans
from tidemark.session import shared_listing
from tidemark.sources.loglines import number_lines, read_log_lines
from tidemark.sources.tail import tail_log_lines
from tidemark.streaming import logs as streams
from tidemark.workdir import fresh_dir, swap_folder

FIELDS = [
    "log_epoch", "file", "line", "log_level", "task_status", "dag_id", "task_id", "execution_date", "start_date",
    "end_date", "exception_trace", "parse_ok", "log_date",
]


def _log_files(spark, sf):
    path = fresh_dir(spark, "logs")
    b.log_lines(spark, sf).select("message").write.text(path)
    return path


def _epoch(records):
    """The timestamp as seconds, which no session zone changes."""
    return records.withColumn("log_epoch", F.unix_seconds("log_timestamp"))


def log_scan(spark, sf):
    return read_log_lines(spark, _log_files(spark, sf)).select("message", "service", "log_type")


def _task_files(spark, sf, most=1000):
    """Log files of a thousand lines each, or of the first of these, in the table's order."""
    path = fresh_dir(spark, "logs")
    lines = b.log_lines(spark, sf).where(F.col("line_no") % 1000 < most)
    per_task = lines.withColumn("task", F.floor(F.col("line_no") / 1000))
    lines = per_task.groupBy("task").agg(F.array_sort(F.collect_list(F.struct("line_no", "message"))).alias("lines"))
    lines.select("task", F.array_join("lines.message", "\n").alias("value")).write.partitionBy("task").text(path)
    return path


def log_line_numbers(spark, sf):
    """Lines read back from text files, with the numbers they have in their files."""
    numbered = number_lines(read_log_lines(spark, _task_files(spark, sf)))
    return numbered.select(F.regexp_extract("file", "task=([0-9]+)", 1).cast("bigint").alias("task"), "line_no", "message")


def log_parse(spark, sf):
    lines = b.log_lines(spark, sf).select("line_no", "message")
    return _epoch(ops.parse_records(ops.drop_noise(lines), b.RUN_DATE)).select("line_no", "message", *FIELDS)


def log_sink_daily(spark, sf):
    """Lines to grouped, cleaned and parsed records in daily partitions."""
    path = fresh_dir(spark, "records")
    plans.write_records(plans.log_records(b.log_lines(spark, sf), b.RUN_DATE), path)
    return _epoch(spark.read.parquet(path)).select("log_file", "first_line", "part", "message", *FIELDS)


def log_long_events(spark, sf):
    """Events of far more lines than a stored row holds, put together again from the stored daily records."""
    path = fresh_dir(spark, "records")
    plans.write_records(plans.log_records(b.bind(spark, sf, b.LONG_LOGS), b.RUN_DATE), path)
    event = ["log_file", "first_line", *[n for n in FIELDS if n != "exception_trace"]]
    in_order = F.array_sort(F.collect_list(F.struct("part", "message", "exception_trace")))
    whole = _epoch(spark.read.parquet(path)).groupBy(*event).agg(in_order.alias("parts"))
    # array_join skips parts without a trace, which come before the failing line.
    trace = F.when(F.array_max(F.transform("parts", lambda p: p["exception_trace"].isNotNull())), F.array_join("parts.exception_trace", "\n"))
    return whole.select(*event, F.array_join("parts.message", "\n").alias("message"), trace.alias("exception_trace"))


def log_stream_ingest(spark, sf):
    """Log files as a stream, line by line, in two runs on one checkpoint: the second adds nothing."""
    return _streamed(spark, _log_files(spark, sf), join_lines=False)


def log_stream_events(spark, sf):
    """Log files as a stream, the lines of an event joined."""
    return _streamed(spark, _task_files(spark, sf), join_lines=True)


def log_tail_events(spark, sf):
    """Log files that grow between two runs and have other names in the second: every line once, events over both runs."""
    live, path, checkpoint = (fresh_dir(spark, n) for n in ("live", "records", "offsets"))
    for most in (617, 1000):
        swap_folder(spark, _task_files(spark, sf, most), live)
        lines = tail_log_lines(spark, live, f"{checkpoint}-registry.json", "part-*.txt")
        streams.tail_to_table(lines, path, checkpoint, b.RUN_DATE).awaitTermination()
    streams.close_events(spark, path, checkpoint, b.RUN_DATE)
    return _epoch(spark.read.parquet(path)).select("message", "service", "log_type", *FIELDS)


def _streamed(spark, source, **options):
    path, checkpoint = fresh_dir(spark, "records"), fresh_dir(spark, "offsets")
    with shared_listing(spark):
        for _ in range(2):
            lines = streams.stream_log_lines(spark, source, "part-*.txt")
            streams.logs_to_table(lines, path, checkpoint, b.RUN_DATE, **options).awaitTermination()
    return _epoch(spark.read.parquet(path)).select("message", "service", "log_type", *FIELDS)


HEAD = r"\[(\d{4}-\d{2}-\d{2}T[0-9:.]+\+\d{4})\] \{(.*?):(\d+)\} (INFO|ERROR) - "
STATE = HEAD + (
    r"Marking task as (\w+)\. dag_id=(.*?), task_id=(.*?), execution_date=(.*?), start_date=(.*?), end_date="
)
END_DATE = r", start_date=.*?, end_date=([^\r\n]*)"
FAILURE = HEAD + r"Task failed with exception((?s:.*))"


def parse_sql(relation: str, keep: str) -> str:
    """The fields of the relation's messages."""

    def state(i: int) -> str:
        return f"CASE WHEN is_state THEN regexp_extract(message, '{STATE}', {i}) END"

    def either(i: int) -> str:
        return f"coalesce({state(i)}, CASE WHEN is_failure THEN regexp_extract(message, '{FAILURE}', {i}) END)"

    stamp = f"strptime({either(1)}, '%Y-%m-%dT%H:%M:%S.%g+0000')"
    return f"""
SELECT {keep}, CAST(epoch({stamp}) AS BIGINT) AS log_epoch, {either(2)} AS file, CAST({either(3)} AS INTEGER) AS line,
  {either(4)} AS log_level,
  CASE WHEN contains(message, 'Task failed with exception') THEN 'FAILED' ELSE {state(5)} END AS task_status,
  {state(6)} AS dag_id, {state(7)} AS task_id, {state(8)} AS execution_date, {state(9)} AS start_date,
  CASE WHEN is_state THEN regexp_extract(message, '{END_DATE}', 1) END AS end_date,
  CASE WHEN is_failure THEN regexp_extract(message, '{FAILURE}', 5) END AS exception_trace,
  is_state OR is_failure AS parse_ok, coalesce(CAST({stamp} AS DATE), {b.D}) AS log_date
FROM (SELECT *, regexp_matches(message, '{STATE}') AS is_state,
        regexp_matches(message, '{FAILURE}') AND NOT regexp_matches(message, '{STATE}') AS is_failure
      FROM {relation} x) m"""


LINES = b.sql(b.LOGS)
QUIET = "message <> '' AND NOT regexp_matches(message, '.*INFO - DagRun.*created.*')"
EVENTS = rf"""(
SELECT file, first_line, part, CAST(count(*) AS INTEGER) AS n_lines, string_agg(message, chr(10) ORDER BY line_no) AS message
FROM (SELECT *, CAST(floor((line_no - first_line) / 500) AS BIGINT) AS part
      FROM (SELECT *, coalesce(max(CASE WHEN regexp_matches(message, '^\[\d{{4}}-') THEN line_no END)
                      OVER (PARTITION BY file ORDER BY line_no), 0) AS first_line FROM {LINES} r) f) p
GROUP BY file, first_line, part)"""
LONG_EVENTS = rf"""(
SELECT file AS log_file, first_line, string_agg(message, chr(10) ORDER BY line_no) AS message
FROM (SELECT *, coalesce(max(CASE WHEN regexp_matches(message, '^\[\d{{4}}-') THEN line_no END)
                OVER (PARTITION BY file ORDER BY line_no), 0) AS first_line FROM {b.sql(b.LONG_LOGS)} r) f
GROUP BY file, first_line)"""
TASK_EVENTS = rf"""(
SELECT task, first_line, string_agg(message, chr(10) ORDER BY line_no) AS message
FROM (SELECT *, coalesce(max(CASE WHEN regexp_matches(message, '^\[\d{{4}}-') THEN line_no END)
                OVER (PARTITION BY task ORDER BY line_no), 0) AS first_line
      FROM (SELECT *, floor(line_no / 1000) AS task FROM {LINES} r) t) f
GROUP BY task, first_line)"""
QUIET_LINES = f"(SELECT * FROM {LINES} q WHERE {QUIET})"

QUERIES = {
    "log_scan": log_scan,
    "log_line_numbers": log_line_numbers,
    "log_drop_noise": lambda s, d: ops.drop_noise(b.log_lines(s, d)),
    "log_multiline": lambda s, d: ops.multiline(b.log_lines(s, d)),
    "log_multiline_literal": lambda s, d: ops.multiline(b.log_lines(s, d), ops.TRACE_PATTERN).drop("message"),
    "log_parse": log_parse,
    "log_sink_daily": log_sink_daily,
    "log_long_events": log_long_events,
    "log_stream_ingest": log_stream_ingest,
    "log_stream_events": log_stream_events,
    "log_tail_events": log_tail_events,
}

ORACLE = {
    "log_scan": f"SELECT message, 'airflow' AS service, 'dag_logs' AS log_type FROM {LINES} r",
    "log_line_numbers": f"SELECT CAST(line_no // 1000 AS BIGINT) AS task, line_no % 1000 AS line_no, message FROM {LINES} r",
    "log_drop_noise": f"SELECT * FROM {LINES} r WHERE {QUIET}",
    "log_multiline": f"SELECT * FROM {EVENTS} e",
    "log_multiline_literal": f"""SELECT file, CAST(0 AS BIGINT) AS first_line, CAST(floor(line_no / 500) AS BIGINT) AS part,
  CAST(count(*) AS INTEGER) AS n_lines FROM {LINES} r GROUP BY ALL""",
    "log_parse": parse_sql(QUIET_LINES, "line_no, message"),
    "log_sink_daily": parse_sql(
        f"(SELECT file AS log_file, first_line, part, message FROM {EVENTS} e WHERE {QUIET})",
        "log_file, first_line, part, message",
    ),
    "log_long_events": parse_sql(
        f"(SELECT * FROM {LONG_EVENTS} e WHERE NOT regexp_matches(message, 'INFO - DagRun[^\\n]*created'))",
        "log_file, first_line, message",
    ),
    "log_stream_ingest": parse_sql(
        f"(SELECT *, 'airflow' AS service, 'dag_logs' AS log_type FROM {QUIET_LINES} q)", "message, service, log_type"
    ),
    "log_stream_events": parse_sql(
        f"(SELECT *, 'airflow' AS service, 'dag_logs' AS log_type FROM {TASK_EVENTS} q WHERE {QUIET})",
        "message, service, log_type",
    ),
}
ORACLE["log_tail_events"] = ORACLE["log_stream_events"]
