"""Scheduler logs to daily records, as a batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame

from tidemark.operators.logs import multiline, parse_parts
from tidemark.sinks.files import write_partitioned
from tidemark.workdir import staged


def log_records(lines: DataFrame, run_date: date, block: Column | None = None, **options) -> DataFrame:
    """Numbered lines to records: group lines, drop noise, parse. The grouped lines are stored on the way."""
    return parse_parts(staged(multiline(lines, block=block, grammar=True, **options), "events"), run_date)


def write_records(records: DataFrame, path: str) -> None:
    """One partition per log day; a repeated run replaces the days it covers."""
    write_partitioned(records, path, ["log_date"], gather=True)
