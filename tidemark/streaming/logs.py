"""Continuous log parsing into daily partitions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import utc_date
from tidemark.operators.logs import drop_noise, multiline, parse_parts, parse_records
from tidemark.sinks.files import write_partitioned
from tidemark.sources.loglines import number_lines
from tidemark.workdir import drop_folder, folder_exists, folder_names, staging


def stream_log_lines(
    spark: SparkSession, path: str, closed: str, service: str = "airflow", log_type: str = "dag_logs", **options: str
) -> DataFrame:
    """Lines of newly arriving closed log files with their tags.

    A file is read once, so lines appended later would be lost. ``closed`` is the pattern of names that only finished
    files have (rotated, or moved in when complete); files that are still written to are not looked at. Many files or folders
    are listed quicker inside ``shared_listing``, which holds while the stream runs.
    """
    return spark.readStream.format("text").option("pathGlobFilter", closed).options(**options).load(path).select(
        F.col("value").alias("message"),
        F.lit(service).alias("service"),
        F.lit(log_type).alias("log_type"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        utc_date(F.col("_metadata.file_modification_time")).alias("arrived"),
    )


COLUMNS = (
    "message", "service", "log_type", "log_timestamp", "file", "line", "log_level", "task_status", "dag_id", "task_id",
    "execution_date", "start_date", "end_date", "exception_trace", "parse_ok", "log_date",
)
WAITING = "open-events"
TAGS = ("service", "log_type", "arrived")
OPEN = "message string, service string, log_type string, file string, block bigint, at bigint, arrived date, idle int"


def _store(records: DataFrame, path: str, batch_id: int) -> None:
    """Replaces what this batch has stored before, if it is run again."""
    rows = records.select(*COLUMNS).withColumn("batch_id", F.lit(batch_id))
    write_partitioned(rows, path, ["log_date", "batch_id"], gather=True)


def _event_records(events: DataFrame, run_date: date | None) -> DataFrame:
    """Records of stored events. Those of one part are whole; only events of several are gathered."""
    long = events.where("part > 0").select("file", "first_line").distinct()
    event = ["file", "first_line"]
    arrived = F.col("arrived")
    whole = drop_noise(events.join(long, event, "left_anti")).select(*events.columns)
    short = parse_records(whole, run_date, arrived=arrived)
    return short.select(*COLUMNS).union(parse_parts(events.join(long, event, "left_semi"), run_date, arrived=arrived).select(*COLUMNS))


def batch_writer(
    path: str, run_date: date | None, join_lines: bool, multiline_options: dict | None = None
) -> Callable[[DataFrame, int], None]:
    """Parses one micro-batch and replaces exactly its own output.

    Below each day a batch owns the partition that carries its number. Records without a readable timestamp are filed
    under ``run_date`` or the day their file was written, never under the day of processing: a batch that is run again
    on a later day finds the same partitions and leaves no second copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not join_lines:
            _store(parse_records(drop_noise(batch), run_date, arrived=F.col("arrived")), path, batch_id)
            return
        numbered = number_lines(batch.withColumn("at", F.monotonically_increasing_id()))
        options = {"block": F.col("block"), "carry": TAGS, "grammar": True, **(multiline_options or {})}
        with staging(multiline(numbered, **options), "events") as events:
            _store(_event_records(events, run_date), path, batch_id)

    return write


def tail_writer(
    path: str, open_path: str, run_date: date | None = None, idle_batches: int = 3, most_open_lines: int = 100_000,
    multiline_options: dict | None = None,
) -> Callable[[DataFrame, int], None]:
    """Joins the lines of events over micro-batches of a tail.

    The last event of a file stays open: its lines wait in the table ``open_path``, below the number of the batch, and stand
    in front of the lines of the next batch. They are stored as a record when the next event starts, when the file has been
    quiet for ``idle_batches`` batches, or when there are more than ``most_open_lines`` of them, which bounds what waits.
    A batch reads what its forerunner has left open and replaces what it has left itself, so it can be run again.
    """
    options = {"block": F.col("block"), "carry": TAGS, "grammar": True, **(multiline_options or {})}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = [f.split()[0] for f in OPEN.split(", ")]
        earlier = f"{open_path}/batch={batch_id - 1}"
        waiting = spark.read.schema(OPEN).parquet(earlier) if folder_exists(spark, earlier) else spark.createDataFrame([], OPEN)
        lines = batch.withColumn("idle", F.lit(0)).select(*names).union(waiting.withColumn("idle", F.col("idle") + 1).select(*names))
        with staging(number_lines(lines.withColumn("position", F.col("at"))), "numbered") as numbered, staging(multiline(numbered, **options), "events") as events:
            # The last event of every file, and how long nothing came: lines of this batch are not idle.
            last = events.groupBy("file").agg(F.max("first_line").alias("last"), F.max(F.col("from_line") + F.col("n_lines")).alias("end"))
            quiet = numbered.groupBy("file").agg(F.min("idle").alias("idle_now"))
            last = last.join(quiet, "file").withColumn("waits", (F.col("idle_now") < idle_batches) & (F.col("end") - F.col("last") <= most_open_lines))
            closed = events.join(last.where("waits").select("file", "last"), "file", "left").where("last IS NULL OR first_line < last")
            _store(_event_records(closed.select(*events.columns), run_date), path, batch_id)
            still = last.where("waits").select("file", "last", "idle_now")
            rest = numbered.join(still, "file").where("line_no >= last")
            rest = rest.withColumn("idle", F.col("idle_now")).withColumn("at", F.col("position"))
            rest.select(*names).write.mode("overwrite").parquet(f"{open_path}/batch={batch_id}")
        drop_folder(spark, f"{open_path}/batch={batch_id - 2}")

    return write


def close_events(spark: SparkSession, path: str, checkpoint: str, run_date: date | None = None) -> None:
    """Stores the events that a stream which has ended has left open; doing so again changes nothing."""
    open_path = f"{checkpoint}/{WAITING}"
    left = [int(name.removeprefix("batch=")) for name in folder_names(spark, open_path) if name.startswith("batch=")]
    if left:
        waiting = spark.read.schema(OPEN).parquet(f"{open_path}/batch={max(left)}")
        tail_writer(path, f"{checkpoint}/closed-events", run_date, idle_batches=0)(waiting.drop("idle"), max(left) + 1)


def tail_to_table(
    lines: DataFrame, path: str, checkpoint: str, run_date: date | None = None, every: str | None = None, **options
) -> StreamingQuery:
    """Starts the ingest of growing log files; open events wait below the checkpoint."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = tail_writer(path, f"{checkpoint}/{WAITING}", run_date, **options)
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(writer).trigger(**trigger).start()


def logs_to_table(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    run_date: date | None = None,
    every: str | None = None,
    join_lines: bool = True,
    multiline_options: dict | None = None,
) -> StreamingQuery:
    """Starts the ingest of log files into a table partitioned by day and batch."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        lines.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(path, run_date, join_lines, multiline_options))
        .trigger(**trigger)
        .start()
    )
