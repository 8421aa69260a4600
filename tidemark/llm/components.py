"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """doc_id and component (the smallest id reachable) of every node of the edges (a, b).

    Every round hangs each node and its neighbours on the smallest id among them, large-star and small-star in turn; the
    number of rounds grows with the logarithm of the longest path. Rounds are written to the shared folder, so that
    neither the plan nor what a lost executor costs grows with them.
    """
    pairs = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
    links = staged(pairs.where("node <> low").distinct(), "links")
    before = _fingerprint(links)
    while True:
        # Large star: larger neighbours of a node hang on the smallest of its neighbours and itself.
        both = links.union(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
        least = both.groupBy("node").agg(F.min("low").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = (
            both.where("low > node")
            .join(least, "node")
            .select(F.col("low").alias("node"), F.col("least").alias("low"))
            .where("node <> low")
            .distinct()
        )
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        lowest = large.groupBy("node").agg(F.min("low").alias("least"))
        small = (
            large.join(lowest, "node")
            .select(F.col("low").alias("node"), F.col("least").alias("low"))
            .union(lowest.select("node", F.col("least").alias("low")))
            .where("node <> low")
            .distinct()
        )
        small = staged(small, "links")
        discard(links)
        links, now = small, _fingerprint(small)
        if now == before:
            break
        before = now
    heads = links.select(F.col("low").alias("doc_id"), F.col("low").alias("component")).distinct()
    found = links.select(F.col("node").alias("doc_id"), F.col("low").alias("component")).union(heads)
    found.staged_path = links.staged_path
    return found


def _fingerprint(links: DataFrame) -> tuple:
    """Number of links and sums of two hashes: the same after a round that changes nothing."""
    sums = (F.sum(F.xxhash64("node", "low", F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2))
    return tuple(links.agg(F.count(F.lit(1)), *sums).first())
