"""Scheduler log lines to structured records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import utc_date

# The shipper's multi-line pattern and its noise pattern.
TRACE_PATTERN = r"^Traceback|^Exception|^\s+File"
NOISE_PATTERN = r"INFO - DagRun.*created"

# Record grammar and timestamp format of the scheduler's log.
STAMP = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:?\d{2}(?::?\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?"
LEVEL = r"(?i:alert|trace|debug|notice|info|warn(?:ing)?|err(?:or)?|crit(?:ical)?|fatal|severe|emerg(?:ency)?)"
HEAD = rf"\[({STAMP})\] \{{(.*?):(\d+)\}} ({LEVEL}) - "
STATE = HEAD + (
    r"Marking task as (\w+)\. dag_id=(.*?), task_id=(.*?), execution_date=(.*?), start_date=(.*?), end_date="
)
FAILURE = HEAD + r"Task failed with exception"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
STATE_TEXT = "Marking task as "
FAILURE_TEXT = "Task failed with exception"

# A record starts where a line starts with a bracketed date.
EVENT_START = r"^\[\d{4}-"
# Lines per independently scanned block of a file.
LINES_PER_BLOCK = 65_536
# Lines that a stored row of an event holds at most. It bounds rows and changes no field of an event.
LINES_PER_PART = 500


def multiline(
    lines: DataFrame,
    pattern: str = EVENT_START,
    negate: bool = True,
    lines_per_part: int = LINES_PER_PART,
    block: Column | None = None,
    carry: tuple[str, ...] = (),
    grammar: bool = False,
) -> DataFrame:
    """Joins the lines of one event, per file and in line order.

    With ``negate`` (match after) a line that does not match the pattern follows
    the last matching one; without it, matching lines follow the last that does
    not match. Input columns: file, line_no, message and the constant columns named
    in ``carry``. Output: file, first_line, part, n_lines, message, carried columns.

    A file is scanned in blocks of lines: each block finds its own event starts,
    and one small row per block tells the next blocks which event is still open.
    Both come from one shuffle of the lines. An event longer than ``lines_per_part``
    lines continues in further parts, so no line is lost and no row grows without
    bound; ``parse_parts`` reads the parts of an event as one.

    With ``grammar`` a part also tells what ``parse_parts`` needs to know of its lines.
    """
    block = block if block is not None else F.floor(F.col("line_no") / LINES_PER_BLOCK)
    matches = F.col("message").rlike(pattern)
    is_start = matches if negate else ~matches
    marked = lines.select(
        "file",
        "line_no",
        "message",
        *carry,
        block.alias("block"),
        F.when(is_start, F.col("line_no")).alias("start"),
    )
    # A line without file or number belongs to no event.
    marked = marked.where(F.col("file").isNotNull() & F.col("block").isNotNull()).repartition("file", "block")
    in_block = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The whole last starting line is taken along: the same columns are shuffled for it as for the lines, once.
    last = F.max(F.struct("start", "line_no", "message", *carry)).alias("last")
    opened = marked.groupBy("file", "block").agg(last)
    open_event = opened.select("file", "block", F.max("last").over(earlier)["start"].alias("open_start"))
    placed = (
        marked.withColumn("start", F.max("start").over(in_block))
        .join(open_event, ["file", "block"])
        .withColumn("first_line", F.coalesce("start", "open_start", F.lit(0).cast("bigint")))
        .withColumn("part", F.floor((F.col("line_no") - F.col("first_line")) / lines_per_part))
    )
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "message")))
    facts = {"from_line": F.min("line_no"), **_line_facts()} if grammar else {}
    return (
        placed.groupBy("file", "first_line", "part")
        .agg(ordered.alias("lines"), *[F.first(c).alias(c) for c in carry], *[f.alias(n) for n, f in facts.items()])
        .select(
            "file",
            "first_line",
            "part",
            F.size("lines").alias("n_lines"),
            F.array_join(F.col("lines.message"), "\n").alias("message"),
            *carry,
            *facts,
        )
    )


def _line_facts(noise: str = NOISE_PATTERN) -> dict[str, Column]:
    """What the lines of a part say: every grammar matches within a line, so the first line that matches decides."""
    line = F.col("message")
    at = F.struct("line_no", "message")
    return {
        "noisy": F.max((line != "") & line.rlike(noise)),
        "failed": F.max(line.contains(FAILURE_TEXT)),
        "state_line": F.min(F.when(line.contains(STATE_TEXT) & line.rlike(STATE), at)),
        "failure_line": F.min(F.when(line.contains(FAILURE_TEXT) & line.rlike(FAILURE), at)),
    }


def drop_noise(events: DataFrame, pattern: str = NOISE_PATTERN) -> DataFrame:
    """Without empty messages and messages about created runs."""
    message = F.col("message")
    return events.where((message != "") & ~message.rlike(pattern))


def _fields(message: Column, text: str, regex: str, groups: int) -> Column:
    """The regex's groups as an array, null where it does not match.

    ``text`` occurs in whatever matches; looking for it first spares most lines the
    regex. One replacement takes all groups out at once: only the last of them can
    hold a line break, so line breaks separate them.
    """
    separated = "\n".join(f"${i + 1}" for i in range(groups))
    taken = F.regexp_replace(message, F.lit(rf"^[\s\S]*?{regex}[\s\S]*$"), F.lit(separated))
    return F.when(message.contains(text) & message.rlike(regex), F.split(taken, "\n", groups))


def parse_records(
    events: DataFrame, run_date: date | None = None, strict: bool = False, arrived: Column | None = None
) -> DataFrame:
    """Adds the record's fields; the first matching grammar wins and unmatched messages stay.

    A row is a whole event. By default the end date is the rest of its line and the trace
    is everything after the failure text, further lines included. ``strict`` keeps to the
    letter of the shipped grammar, where the end date stays empty and the trace ends with
    its line. Records without a readable timestamp are filed under the run date, else the
    day they ``arrived``, else today.
    """
    message = F.col("message")
    trace = r"(.*)" if strict else r"(?s:(.*))"
    parsed = events.withColumn("_state", _fields(message, STATE_TEXT, STATE + _end(strict), 10)).withColumn(
        "_failure", F.when(F.col("_state").isNull(), _fields(message, FAILURE_TEXT, FAILURE + trace, 5))
    )
    return _records(parsed, events.columns, message.contains(FAILURE_TEXT), F.get("_failure", 4), run_date, strict, arrived)


def parse_parts(
    parts: DataFrame, run_date: date | None = None, strict: bool = False, arrived: Column | None = None
) -> DataFrame:
    """The records of events that ``multiline(..., grammar=True)`` grouped, one row per part, without noise.

    What the lines of all parts say is gathered per event first, one small row each: noise takes all parts away, and
    every part carries the event's fields and day. The trace is cut like the event; joined in order it is whole.
    ``parts`` is read twice and should be a stored table.
    """
    event = ["file", "first_line"]
    whole = parts.groupBy(*event).agg(
        F.max("noisy").alias("noisy"),
        F.max("failed").alias("failed"),
        F.min("state_line").alias("state_line"),
        F.min("failure_line").alias("failure_line"),
        F.sum("n_lines").alias("lines"),
        F.max(F.length("message")).alias("longest"),
    )
    quiet = whole.where(~F.col("noisy") & ~((F.col("lines") == 1) & (F.col("longest") == 0))).drop("noisy", "lines", "longest")
    given = [c for c in parts.columns if c not in ("from_line", *_line_facts())]
    parsed = (
        parts.select(*given, "from_line")
        .join(quiet, event)
        .withColumn("_state", _fields(F.col("state_line.message"), STATE_TEXT, STATE + _end(strict), 10))
        .withColumn("_failure", _fields(F.col("failure_line.message"), FAILURE_TEXT, FAILURE + "(.*)", 5))
        .withColumn("_failure", F.when(F.col("_state").isNull(), F.col("_failure")))
    )
    # Lines of this part behind the failing one; negative if that comes later, all of them if it came earlier.
    behind = F.col("from_line") + F.col("n_lines") - 1 - F.col("failure_line.line_no")
    rest = F.get("_failure", 4)
    if strict:
        trace = F.when((behind >= 0) & (behind < F.col("n_lines")), rest)
    else:
        tail = F.expr("substring_index(message, '\\n', -CAST(from_line + n_lines - 1 - failure_line.line_no AS INT))")
        trace = (
            F.when(behind >= F.col("n_lines"), F.col("message"))
            .when(behind > 0, F.concat(rest, F.lit("\n"), tail))
            .when(behind == 0, rest)
        )
    trace = F.when(F.col("_failure").isNotNull(), trace)
    return _records(parsed, given, F.col("failed"), trace, run_date, strict, arrived)


def _end(strict: bool) -> str:
    return r"()" if strict else r"([^\r\n]*)"


def _records(
    parsed: DataFrame, columns: list[str], failed: Column, trace: Column, run_date: date | None, strict: bool, arrived: Column | None
) -> DataFrame:
    def state(group: int) -> Column:
        return F.get("_state", group - 1)

    def either(group: int) -> Column:
        return F.coalesce(state(group), F.get("_failure", group - 1))

    stamp = F.try_to_timestamp(either(1), F.lit(STAMP_FORMAT))
    end_date = F.lit(None).cast("string") if strict else state(10)
    filed = F.lit(run_date) if run_date else F.current_date() if arrived is None else arrived
    given = [F.col(n).alias("log_file") if n == "file" else F.col(n) for n in columns]
    return parsed.select(
        *given,
        stamp.alias("log_timestamp"),
        either(2).alias("file"),
        either(3).try_cast("int").alias("line"),
        either(4).alias("log_level"),
        F.when(failed, F.lit("FAILED")).otherwise(state(5)).alias("task_status"),
        state(6).alias("dag_id"),
        state(7).alias("task_id"),
        state(8).alias("execution_date"),
        state(9).alias("start_date"),
        end_date.alias("end_date"),
        trace.alias("exception_trace"),
        (F.col("_state").isNotNull() | F.col("_failure").isNotNull()).alias("parse_ok"),
        F.coalesce(utc_date(stamp), filed).alias("log_date"),
    )
