from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import logs as ops
from tidemark.plans.logs import log_records, write_records
from tidemark.workdir import staged
from tidemark.sources.loglines import number_lines, read_log_lines

DAY = date(2024, 2, 1)
HEAD = "[2024-01-05T23:30:00.000+0000] {taskinstance.py:12} "
OK = HEAD + "INFO - Marking task as SUCCESS. dag_id=d, task_id=t, execution_date=e, start_date=s, end_date=x"
FAIL = HEAD + "ERROR - Task failed with exception"


def lines(spark, *messages, file="f"):
    return spark.createDataFrame([(file, i, m) for i, m in enumerate(messages)], "file string, line_no bigint, message string")


def reference_events(messages, is_start, size):
    """Event grouping by a plain loop."""
    found, start = {}, 0
    for i, message in enumerate(messages):
        if is_start(message):
            start = i
        found.setdefault((start, (i - start) // size), []).append(message)
    return sorted((s, p, "\n".join(ms)) for (s, p), ms in found.items())


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
@pytest.mark.parametrize("size", [2, 500])
def test_grouping_does_not_depend_on_blocks(spark, block, size):
    messages = ["lead", "in", "[2024-a", "b", "c", "d", "[2024-e", "[2024-f", "g"]
    got = ops.multiline(
        lines(spark, *messages), lines_per_part=size, block=F.floor(F.col("line_no") / block)
    ).select("first_line", "part", "message")
    expected = reference_events(messages, lambda m: m.startswith("[2024-"), size)
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_files_are_grouped_apart(spark, rows):
    both = lines(spark, "[2024-a", "b").union(lines(spark, "c", "[2024-d", file="g"))
    got = rows(ops.multiline(both), "file", "first_line", "n_lines", "message")
    assert got == [("f", 0, 2, "[2024-a\nb"), ("g", 0, 1, "c"), ("g", 1, 1, "[2024-d")]


def test_literal_pattern_and_its_opposite(spark):
    messages = ["start", "Traceback (most", "  File x", "boom", "more"]
    got = ops.multiline(lines(spark, *messages), ops.TRACE_PATTERN).orderBy("first_line")
    assert [r.message for r in got.collect()] == ["start", "Traceback (most", "  File x\nboom\nmore"]
    got = ops.multiline(lines(spark, *messages), ops.TRACE_PATTERN, negate=False).orderBy("first_line")
    assert [r.message for r in got.collect()] == ["start\nTraceback (most\n  File x", "boom", "more"]


def test_a_long_event_loses_no_line(spark):
    many = spark.range(3_000).selectExpr("'f' AS file", "id AS line_no", "concat('line ', id) AS message")
    parts = ops.multiline(many, lines_per_part=500, block=F.floor(F.col("line_no") / 64)).orderBy("part").collect()
    assert [p.n_lines for p in parts] == [500] * 6
    assert "\n".join(p.message for p in parts) == "\n".join(f"line {i}" for i in range(3_000))


def test_noise(spark, rows):
    df = lines(spark, "", "x INFO - DagRun a was created now", "INFO - DagRun a", "kept")
    assert rows(ops.drop_noise(df), "message") == [("INFO - DagRun a",), ("kept",)]


def test_records(spark):
    got = ops.parse_records(lines(spark, OK, FAIL + " boom\nTraceback\nlast", "free"), DAY).orderBy("line_no").collect()
    ok, fail, free = got
    assert (ok.file, ok.line, ok.log_level, ok.task_status) == ("taskinstance.py", 12, "INFO", "SUCCESS")
    assert (ok.dag_id, ok.task_id, ok.execution_date, ok.start_date, ok.end_date) == ("d", "t", "e", "s", "x")
    assert ok.log_timestamp == datetime(2024, 1, 5, 23, 30) and ok.log_date == date(2024, 1, 5)
    assert (fail.task_status, fail.exception_trace, fail.parse_ok) == ("FAILED", " boom\nTraceback\nlast", True)
    assert (free.parse_ok, free.log_level, free.task_status, free.log_date) == (False, None, None, DAY)


def test_failure_text_sets_the_status_even_without_grammar(spark):
    row = ops.parse_records(lines(spark, "Task failed with exception"), DAY).first()
    assert row.task_status == "FAILED" and not row.parse_ok


def test_strict_grammar(spark):
    ok, fail = ops.parse_records(lines(spark, OK, FAIL + " boom\nTraceback"), DAY, strict=True).orderBy("line_no").collect()
    assert ok.end_date is None and ok.start_date == "s"
    assert fail.exception_trace == " boom"


def test_unreadable_timestamp_goes_to_the_run_date(spark):
    row = ops.parse_records(lines(spark, OK.replace("T23:30:00.000+0000", " 23:30")), DAY).first()
    assert row.parse_ok and row.log_timestamp is None and row.log_date == DAY


def test_line_numbers_over_split_files(spark, tmp_path):
    texts = {"a.log": [f"{'[2024-' if i % 7 == 0 else ''}a{i} {'x' * (i % 50)}" for i in range(400)], "b.log": ["b0", "", "b2"]}
    for name, body in texts.items():
        (tmp_path / name).write_text("\n".join(body) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        raw = read_log_lines(spark, str(tmp_path))
        assert raw.select("file", "block").distinct().count() > 5
        numbered = number_lines(raw)
        got = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.message) for r in numbered.collect())
        assert got == sorted((name, i, m) for name, body in texts.items() for i, m in enumerate(body))
        events = ops.multiline(numbered, r"^\[2024-", block=F.col("block"), carry=("service",))
        first = events.where(F.col("file").endswith("a.log")).orderBy("first_line").collect()
        assert [e.first_line for e in first] == list(range(0, 400, 7))
        assert first[3].message == "\n".join(texts["a.log"][21:28]) and first[3].service == "airflow"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_daily_records(spark, tmp_path):
    path = str(tmp_path / "records")
    source = lines(spark, OK, "", "[2024-01-06T00:00:00.000+0000] {x.py:1} ERROR - Task failed with exception", "trace")
    for _ in range(2):
        write_records(log_records(source, DAY), path)
    got = spark.read.parquet(path).orderBy("first_line").collect()
    assert [(r.log_date, r.task_status, r.exception_trace) for r in got] == [
        (date(2024, 1, 5), "SUCCESS", None),
        (date(2024, 1, 6), "FAILED", "\ntrace"),
    ]


def long_events(spark):
    """Failures, noise and state changes with many lines each, and lines before any event."""
    body = ["lead", ""]
    body += [FAIL + " first"] + [f"  File {i}" for i in range(11)] + [""]
    body += [HEAD + "INFO - DagRun z was created"] + [f"n{i}" for i in range(9)]
    body += [OK] + [f"more {i}" for i in range(5)] + [FAIL]
    body += ["[2024-x"] + ["before"] * 4 + [FAIL[1:] + " late", FAIL[1:] + " later", "tail", "", "end"]
    body += ["[2024-y", "quiet", "x INFO - DagRun q created", "z"]
    return lines(spark, *body)


@pytest.mark.parametrize("strict", [False, True])
def test_no_field_depends_on_the_size_of_parts(spark, strict):
    def whole(size):
        parts = staged(ops.multiline(long_events(spark), lines_per_part=size, grammar=True), "parts")
        fields = {}
        for r in sorted(ops.parse_parts(parts, DAY, strict).collect(), key=lambda r: (r.first_line, r.part)):
            r = r.asDict()
            message, trace = r.pop("message"), r.pop("exception_trace")
            del r["part"], r["n_lines"]
            known = fields.setdefault(r["first_line"], (r, [], []))
            assert known[0] == r
            known[1].append(message)
            known[2].extend([] if trace is None else [trace])
        return {k: (r, "\n".join(m), "\n".join(t) if t else None) for k, (r, m, t) in fields.items()}

    expected = {}
    for r in ops.parse_records(ops.drop_noise(ops.multiline(long_events(spark), lines_per_part=10**6)), DAY, strict).collect():
        r = r.asDict()
        message, trace = r.pop("message"), r.pop("exception_trace")
        del r["part"], r["n_lines"]
        expected[r["first_line"]] = (r, message, trace)
    assert len(expected) == 5
    for size in (1, 2, 3, 500, 10**6):
        assert whole(size) == expected, size


def test_an_event_of_one_empty_line_is_noise(spark):
    parts = staged(ops.multiline(lines(spark, ""), grammar=True), "parts")
    assert ops.parse_parts(parts, DAY).count() == 0
    parts = staged(ops.multiline(lines(spark, "", ""), lines_per_part=1, grammar=True), "parts")
    assert ops.parse_parts(parts, DAY).count() == 2


def test_lines_are_scanned_once(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(["[2024-a", "b"] * 50))
    events = ops.multiline(number_lines(read_log_lines(spark, str(tmp_path))), block=F.col("block"))
    events.collect()
    final = events._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1
