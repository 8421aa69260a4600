"""Nearest neighbours by inner product through multi-index hashing of learned binary codes.

Codes: vectors are centred and turned by rotations that lose least by taking signs (iterative quantisation from several
random starts, on a bounded sample); about BITS signs are a code. Index: vectors are dealt into shards of bounded size;
in each the codes are split into substrings of 16 bits, and every substring has its own table from value to codes. Search:
a code within Hamming radius r of the query's is, by the pigeonhole principle, within r / m of it in one of m substrings
(more exactly: within q in one of the first r % m + 1 or within q - 1 in one of the others, q = r // m). The tables are
probed at these radii, what they give is checked on whole codes, and codes within r are ranked by the inner product of the
original vectors in double precision. A shard that finds fewer than asked widens r until it has them all.

r is what holds RECALL of the true neighbours within the sample; in the whole table neighbours lie closer, not further.

Equal vectors are one entry that carries the smallest ids, so a frequent vector is no burden. Every shard answers every
block of queries with its best, and the best of these are the result.

Defined results: vectors that are null, zero, empty or hold a null or a non-finite number take no part, nor do those whose
length isn't the most frequent one, nor rows without an id. Rows that repeat an id and a vector are one row; rows that
share an id with different vectors are one item, which is as near as its nearest vector and never its own neighbour. With
fewer candidates than asked all are returned. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

BITS = 256
SUBSTRING = 16
#: Distinct vectors that rotations and radius are learned from, those with the smallest digests.
SAMPLE = 8_000
RECALL = 0.97
#: Distinct vectors in a shard and queries in a block, on average.
SHARD = 16_384
QUERY_BLOCK = 2_048
SEED = 20240202

_ONES = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32)).astype(np.uint8)


class Model(NamedTuple):
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of substrings, filled up with zero bits."""
        bits = (vectors - self.mean) @ self.rotation > 0
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
        return np.packbits(bits, axis=1).view(np.uint16)


def rotation_of(centred: np.ndarray, random: np.random.Generator, rounds: int = 20) -> np.ndarray:
    """A rotation under which signs are close to the values, improved from a random start."""
    turn = np.linalg.qr(random.normal(size=(centred.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(centred @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ centred)
        turn = (left @ right).T
    return turn


def fit(sample: np.ndarray, k: int) -> Model:
    """Rotations and radius from sampled vectors (n, d)."""
    random = np.random.default_rng(SEED)
    mean = sample.mean(axis=0)
    starts = -(-BITS // sample.shape[1])
    model = Model(mean, np.hstack([rotation_of(sample - mean, random) for _ in range(starts)]), 0)
    codes = model.codes(sample)
    asked = random.permutation(len(sample))[:400]
    if len(sample) <= 2 * k:
        return model._replace(radius=codes.shape[1] * SUBSTRING)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-scores, k, axis=1)[:, :k]
    apart = np.bitwise_count(codes[asked][:, None, :] ^ codes[near]).sum(axis=2)
    return model._replace(radius=math.ceil(np.quantile(apart, RECALL)))


class Index:
    """The substring tables of a shard."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.whole = np.ascontiguousarray(codes).view(np.uint64)
        self.tables = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, starts = np.unique(codes[order, j], return_index=True)
            self.tables.append((values, order, starts, np.append(starts[1:], len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all codes within a Hamming radius of a code."""
        m = len(self.tables)
        each, over = divmod(radius, m)
        found = np.zeros(len(self.codes), bool)
        for j, (values, order, starts, ends) in enumerate(self.tables):
            reach = each if j <= over else each - 1
            if reach < 0:
                continue
            # The filled buckets of the table in reach; there are never more of them than codes.
            near = np.flatnonzero(_ONES[values ^ code[j]] <= reach)
            if not len(near):
                continue
            sizes = ends[near] - starts[near]
            places = np.repeat(starts[near] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            found[order[places]] = True
        numbers = np.flatnonzero(found)
        apart = np.bitwise_count(self.whole[numbers] ^ np.ascontiguousarray(code).view(np.uint64)).sum(axis=1)
        return numbers[apart <= radius]


def search(index: Index, vectors: np.ndarray, ids: list[list[int]], model: Model, queries: np.ndarray, n: int) -> Iterator[list[tuple]]:
    """For each query the best n of (score, id), best first, ties to the smaller id."""
    widest = model.rotation.shape[1]
    held = np.array([len(i) for i in ids])
    for query, code in zip(queries, model.codes(queries), strict=True):
        radius = model.radius
        near = index.within(code, radius)
        while held[near].sum() < n and radius < widest:
            radius += max(1, widest // 16)
            near = index.within(code, radius)
        scores = np.einsum("ij,j->i", vectors[near], query)
        if len(near) > n:
            # The n-th best score; equal ones stay, as their ids decide.
            bound = np.partition(scores, len(near) - n)[len(near) - n]
            near, scores = near[scores >= bound], scores[scores >= bound]
        best = sorted((-s, i) for s, e in zip(scores.tolist(), near.tolist(), strict=True) for i in ids[e])[:n]
        yield [(-s, i) for s, i in best]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, a digest of the vector and the vector as packed doubles of all rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, packed = [], [], []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                if vec_id is None or not vector.is_valid or not len(vector) or vector.values.null_count:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    ids.append(vec_id)
                    packed.append(x.tobytes())
                    keys.append(hashlib.sha256(packed[-1]).digest()[:16])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["vec_id", "key", "vector"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = staged(rows.mapInArrow(run, "vec_id long, key binary, vector binary"), "vectors")
    common = rows.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.length("vector") == common[0]["size"]) if common else rows


def _number(key: str, n: int) -> Column:
    return (F.conv(F.substring(F.hex(key), 1, 14), 16, 10).cast("long") % F.lit(n)).cast("int")


def _sample(entries: DataFrame, n: int) -> np.ndarray:
    """At most SAMPLE vectors, those with the smallest digests; a first cut keeps what is sorted small, too."""
    share = min(1.0, 4 * SAMPLE / max(1, n))
    few = entries if share == 1 else entries.where(F.col("key") < F.lit(bytearray(int(share * 2**64).to_bytes(8, "big"))))
    rows = few.orderBy("key").limit(SAMPLE).select("vector").collect()
    return np.array([np.frombuffer(r["vector"], np.float64) for r in rows])


def _shards(entries: DataFrame, shards: int) -> DataFrame:
    """One row per shard: ids of every entry, and all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for shard, ids, vector in zip(*(batch.column(c).to_pylist() for c in ("shard", "ids", "vector")), strict=True):
                own = held.setdefault(shard, ([], []))
                own[0].append(ids)
                own[1].append(vector)
        for shard, (ids, packed) in held.items():
            yield pa.RecordBatch.from_pydict({"shard": [shard], "ids": [ids], "vectors": [b"".join(packed)]}, schema=schema)

    schema = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))), ("vectors", pa.binary())])
    dealt = entries.withColumn("shard", _number("key", shards)).repartitionById(shards, F.col("shard"))
    return dealt.mapInArrow(run, "shard int, ids array<array<long>>, vectors binary")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of every query; ``is_query`` is a condition on ``vec_id``."""
    rows = usable(vectors, id_col, vector_col)
    # An entry's ids beyond the k + 1 smallest can't be among the k nearest of anything. The limit works before the shuffle.
    first = F.dense_rank().over(Window.partitionBy("key").orderBy("vec_id"))
    few = rows.withColumn("place", first).where(F.col("place") <= k + 1)
    entries = few.groupBy("key").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("vector").alias("vector"))
    entries = staged(entries, "entries")
    n = entries.count()
    if not n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    model = fit(_sample(entries, n), k)
    dims = len(model.mean)
    shards = -(-n // SHARD)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "key").distinct()
    asked = staged(entries.join(queries.select("key").distinct(), "key", "left_semi").select("key", "vector"), "queries")
    blocks = -(-asked.count() // QUERY_BLOCK) or 1

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for block, key, vector in zip(*(batch.column(c).to_pylist() for c in ("block", "key", "vector")), strict=True):
                own = held.setdefault(block, ([], []))
                own[0].append(key)
                own[1].append(vector)
        for keys, packed in held.values():
            yield pa.RecordBatch.from_pydict({"keys": [keys], "queries": [b"".join(packed)]}, schema=pa.schema([("keys", pa.list_(pa.binary())), ("queries", pa.binary())]))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index, held, ids = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("shard")[i].as_py()
                if shard != last:
                    held = np.frombuffer(batch.column("vectors")[i].as_buffer(), np.float64).reshape(-1, dims)
                    last, ids, index = shard, batch.column("ids")[i].as_py(), Index(model.codes(held))
                wanted = np.frombuffer(batch.column("queries")[i].as_buffer(), np.float64).reshape(-1, dims)
                keys = batch.column("keys")[i].as_py()
                found = [(key, s, v) for key, best in zip(keys, search(index, held, ids, model, wanted, k + 1), strict=True) for s, v in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64())],
                    ["key", "score", "vec_id"],
                )

    blocked = asked.withColumn("block", _number("key", blocks)).repartitionById(blocks, F.col("block"))
    blocked = blocked.mapInArrow(gather, "keys array<binary>, queries binary")
    # Every block of queries meets every shard.
    asking = blocked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = _shards(entries, shards).join(asking, "shard").mapInArrow(answer, "key binary, score double, vec_id long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    best = (
        found.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k + 1)
        .groupBy("key")
        .agg(F.collect_list(F.struct("score", "vec_id")).alias("best"))
    )
    pairs = (
        queries.join(best, "key")
        .select("query_id", F.explode("best").alias("b"))
        .where("b.vec_id <> query_id")
        .groupBy("query_id", F.col("b.vec_id").alias("vec_id"))
        .agg(F.max("b.score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
