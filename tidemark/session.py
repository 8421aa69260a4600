"""Session settings. Jobs work on any session; this one carries the tuned defaults."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # AQE re-plans joins from real shuffle sizes, merges small partitions and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A side is broadcast only when Spark's own size estimate is below this.
    "spark.sql.autoBroadcastJoinThreshold": str(50 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Builds the session.

    ``shuffle_partitions`` is the upper bound AQE starts from; on a cluster take
    shuffled bytes / 128 MiB and let AQE merge what turns out small. Connector
    packages, catalogs and object-store settings go in ``extra``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def shared_listing(spark: SparkSession, per_core: int = 4) -> Iterator[None]:
    """Folders and files are listed by a few tasks per core, many paths to each, until the block ends.

    By itself Spark starts a task for every path, up to 10,000, and a file stream lists all its paths three times a run.
    """
    given = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(given), per_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, given)
