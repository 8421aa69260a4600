from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.entrypoints.logs import _streamed
from tidemark.operators.news import to_messages
from tidemark.plans.news import publish, relevant_messages
from tidemark.schemas import NEWS
from tidemark.session import LISTING_TASKS
from tidemark.sources import topics
from tidemark.sources.landing import normalise_feed
from tidemark.streaming import logs, news

DAY = date(2024, 2, 1)


def article(spark, *names):
    return spark.createDataFrame([(n, f"Gatorade {n}", None, "", "") for n in names], NEWS)


def test_files_one_by_one_equal_the_batch_and_a_restart_adds_nothing(spark, tmp_path, rows):
    topic, path, checkpoint = (str(tmp_path / n) for n in ("topic", "news", "cp"))
    for name in "abc":
        to_messages(article(spark, name)).coalesce(1).write.mode("append").text(topic)

    def run():
        messages = topics.stream_topic(spark, "text", topic, maxFilesPerTrigger="1")
        query = news.news_to_table(messages, path, checkpoint, DAY)
        query.awaitTermination()
        return query

    assert len(run().recentProgress) >= 3
    run()
    assert rows(spark.read.parquet(path), "source", "link", "ingest_date") == [(n, None, DAY) for n in "abc"]
    to_messages(article(spark, "d")).write.mode("append").text(topic)
    run()
    assert spark.read.parquet(path).count() == 4


def test_running_service_picks_up_new_messages(spark, tmp_path):
    topic, path = str(tmp_path / "topic"), str(tmp_path / "news")
    to_messages(article(spark, "a")).write.mode("append").text(topic)
    query = news.news_to_table(
        topics.stream_topic(spark, "text", topic), path, str(tmp_path / "cp"), DAY, every="1 second"
    )
    try:
        query.processAllAvailable()
        to_messages(article(spark, "b")).write.mode("append").text(topic)
        query.processAllAvailable()
        assert spark.read.parquet(path).count() == 2
    finally:
        query.stop()


def test_broken_messages_can_be_left_out(spark, tmp_path):
    topic, path = str(tmp_path / "topic"), str(tmp_path / "news")
    spark.createDataFrame([("{",), ('{"source":"s"}',)], "value string").write.text(topic)
    messages = topics.stream_topic(spark, "text", topic)
    news.news_to_table(messages, path, str(tmp_path / "cp"), drop_malformed=True).awaitTermination()
    assert spark.read.parquet(path).count() == 1


def test_published_stream_equals_published_batch(spark, tmp_path, rows):
    entries = spark.createDataFrame(
        [("s", '{"title":"Gatorade"}'), ("s", '{"title":"other"}'), ("s", '{"summary":"성장세"}')], "source string, entry string"
    )
    landed, streamed, batch = (str(tmp_path / n) for n in ("landed", "streamed", "batch"))
    entries.write.parquet(landed)
    stream = normalise_feed(spark.readStream.schema(entries.schema).parquet(landed))
    news.relevant_to_topic(stream, str(tmp_path / "cp"), "text", streamed).awaitTermination()
    publish(relevant_messages(entries), "text", batch)
    assert rows(spark.read.text(streamed)) == rows(spark.read.text(batch))
    assert spark.read.text(batch).count() == 2


HEAD = "[2024-01-05T00:00:00.000+0000] {x.py:1} "


def test_log_files_become_daily_records_once(spark, tmp_path):
    source, path, checkpoint = tmp_path / "logs", str(tmp_path / "records"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.log").write_text(HEAD + "ERROR - Task failed with exception\nTraceback\n  File y\n\n" + HEAD + "INFO - DagRun z created\n")
    (source / "b.log").write_text("plain\n")

    def run():
        lines = logs.stream_log_lines(spark, str(source), "*.log", maxFilesPerTrigger="1")
        logs.logs_to_table(lines, path, checkpoint, DAY).awaitTermination()

    run()
    run()
    got = spark.read.parquet(path).orderBy("message").collect()
    assert [(r.log_date, r.task_status, r.exception_trace) for r in got] == [
        (date(2024, 1, 5), "FAILED", "\nTraceback\n  File y\n"),
        (DAY, None, None),
    ]


def test_a_batch_that_is_run_again_on_another_day_replaces_itself(spark, tmp_path, rows):
    path = str(tmp_path / "records")
    ddl = "message string, service string, log_type string, file string, block bigint, arrived date"
    batch = spark.createDataFrame([("plain", "s", "l", "f", 0, DAY), (HEAD + "x", "s", "l", "f", 0, DAY)], ddl)
    for join_lines in (False, True):
        # No run date: the default must not depend on the clock.
        write = logs.batch_writer(path, None, join_lines=join_lines)
        for number in (0, 0, 1):
            write(batch, number)
        got = spark.read.parquet(path).groupBy("batch_id", "log_date").agg(F.count("*").alias("n"))
        assert rows(got) == [(0, DAY, 2), (1, DAY, 2)]


def test_days_are_the_first_level(spark, tmp_path):
    path = tmp_path / "records"
    ddl = "message string, service string, log_type string, file string, block bigint, arrived date"
    logs.batch_writer(str(path), None, True)(spark.createDataFrame([("plain", "s", "l", "f", 0, DAY)], ddl), 7)
    assert [p.name for p in path.glob("log_date=*")] == ["log_date=2024-02-01"]
    assert [p.name for p in path.glob("log_date=*/*")] == ["batch_id=7"]


def test_files_still_written_to_are_not_read(spark, tmp_path, rows):
    source, path, checkpoint = tmp_path / "logs", str(tmp_path / "records"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.log").write_text("one\n")
    (source / "b.log.1").write_text("closed\n")

    def run():
        lines = logs.stream_log_lines(spark, str(source), "*.log.[0-9]*")
        logs.logs_to_table(lines, path, checkpoint, DAY, join_lines=False).awaitTermination()
        return rows(spark.read.parquet(path), "message")

    assert run() == [("closed",)]
    with (source / "a.log").open("a") as file:
        file.write("two\n")
    assert run() == [("closed",)]
    (source / "a.log").rename(source / "a.log.1")
    assert run() == run() == [("closed",), ("one",), ("two",)]


def test_messages_are_published_once_whatever_fails(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "topic")
    write, real = news.once_writer(path), news.enter

    def fails(*_):
        raise OSError("lost between writing and entering")

    monkeypatch.setattr(news, "enter", fails)
    for _ in range(2):
        try:
            write(article(spark, "a", "b"), 0)
        except OSError:
            pass
    monkeypatch.setattr(news, "enter", real)
    write(article(spark, "a", "b"), 0)
    write(article(spark, "a", "b"), 0)
    monkeypatch.setattr(news, "enter", fails)
    try:
        write(article(spark, "c"), 1)
    except OSError:
        pass
    # The second batch is written and not entered: nobody sees it yet.
    assert news.published(spark, path).count() == 2
    monkeypatch.setattr(news, "enter", real)
    write(article(spark, "c"), 1)
    assert sorted(r["value"].count("Gatorade") for r in news.published(spark, path).collect()) == [1, 1, 1]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    for i in range(60):
        (tmp_path / f"task={i}").mkdir()
        (tmp_path / f"task={i}" / "part-0.txt").write_text("x\n")
    context, given = spark.sparkContext, spark.conf.get(LISTING_TASKS)
    most = []

    def listed(session, source, closed):
        context.setJobGroup("listing", "listing")
        stream_log_lines(session, str(tmp_path), closed)
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        most.append(max(tracker.getStageInfo(s).numTasks for s in stages))
        raise RuntimeError("seen")

    stream_log_lines = logs.stream_log_lines
    monkeypatch.setattr(logs, "stream_log_lines", listed)
    try:
        with pytest.raises(RuntimeError, match="seen"):
            _streamed(spark, str(tmp_path), join_lines=True)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert most == [4 * context.defaultParallelism]
    assert spark.conf.get(LISTING_TASKS) == given
