"""Exact duplicates by a minimal perfect hash over the distinct digests of a historical corpus.

History is reduced to one row per distinct digest with its winner (largest id) and its number of rows. The digests are
dealt into shards of bounded size; a task builds a minimal perfect hash per shard whose slots hold the full digest and
the winner's locator. Incoming digests look their slot up and compare all 32 bytes: members are repeats of history, the
rest are grouped among themselves. Copies are pre-aggregated before every shuffle.

Defined results:
- a null text is empty; texts are equal if identical after lower-casing A-Z only;
- of equal texts the row with the largest id stays; a null id stays only if the group has no other;
- rows that repeat both id and text are the same document: each is returned, and all are kept or none;
- empty tables give no rows, other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, staged, texts_of

#: Rows of history in a shard on average: an index of about 3 MB.
SHARD_ROWS = 50_000
#: Bits per key at each level of the hash.
GAMMA = 1.5


class PerfectHash:
    """A minimal perfect hash: level by level, keys that have a bit of their own keep it, the others move on.

    The slot of a key is the rank of its bit over all levels.
    """

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.ranks = np.cumsum([0, *(int(b.sum()) for b in bits)])
        self.before = [np.cumsum(b) - b + r for b, r in zip(bits, self.ranks, strict=False)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit numbers."""
        bits, level = [], 0
        while len(keys):
            size = max(64, int(len(keys) * GAMMA))
            place = mix(keys, level + 1) % np.uint64(size)
            hits = np.bincount(place.astype(np.int64), minlength=size)
            bits.append(hits == 1)
            keys = keys[hits[place.astype(np.int64)] > 1]
            level += 1
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 where the key is surely no member."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            if not len(open_):
                break
            place = (mix(keys[open_], level + 1) % np.uint64(len(bits))).astype(np.int64)
            here = bits[place]
            found[open_[here]] = self.before[level][place[here]]
            open_ = open_[~here]
        return found


def _keys(digests: np.ndarray) -> np.ndarray:
    """64 bits of each digest (n, 32), other than those that choose the shard."""
    return np.ascontiguousarray(digests[:, 8:16]).view("<u8").ravel()


def _matrix(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and SHA-256 of every text after lower-casing A-Z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [hashlib.sha256(text.lower()).digest() for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], ["doc_id", "digest"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary")


def winners(digests: DataFrame) -> DataFrame:
    """One row per distinct digest: the largest id and the number of rows; map-side combined."""
    return digests.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n_rows"))


def _sharded(distinct: DataFrame, shards: int) -> DataFrame:
    head = F.conv(F.substring(F.hex("digest"), 1, 14), 16, 10).cast("long")
    return distinct.withColumn("shard", (head % F.lit(shards)).cast("int"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the bits of the hash by level, and per slot the digest, the winner and the number of rows."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(pdf["digest"])
        hashed = PerfectHash.build(_keys(digests))
        order = np.argsort(hashed.slots(_keys(digests)))
        # A missing id must survive the trip through whole numbers.
        known = pdf["winner"].notna().to_numpy()[order]
        return pd.DataFrame(
            {
                "shard": [int(pdf["shard"].iloc[0])],
                "levels": [[len(b) for b in hashed.bits]],
                "bits": [b"".join(np.packbits(b).tobytes() for b in hashed.bits)],
                "digests": [digests[order].tobytes()],
                "winners": [pdf["winner"].fillna(0).astype("int64").to_numpy()[order].tobytes()],
                "known": [np.packbits(known).tobytes()],
                "counts": [pdf["n_rows"].to_numpy(np.int64)[order].tobytes()],
            }
        )

    # Ids stay whole: pandas would turn a nullable long into a float.
    rows = _sharded(history, shards).select(
        "shard", "digest", F.col("winner").cast("string").alias("winner"), "n_rows"
    )

    def from_text(pdf: pd.DataFrame) -> pd.DataFrame:
        return build(pdf.assign(winner=pdf["winner"].astype("Int64")))

    schema = "shard int, levels array<int>, bits binary, digests binary, winners binary, known binary, counts binary"
    return rows.groupBy("shard").applyInPandas(from_text, schema)


def lookup(index: DataFrame, incoming: DataFrame, shards: int) -> DataFrame:
    """Adds what history says of each incoming distinct digest: ``old_rows`` (0: no member) and ``old_winner``."""

    def find(slots: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = asked[["digest"]].assign(old_rows=0, old_winner=None)
        if not len(asked) or not len(slots):
            return out
        row = slots.iloc[0]
        bits, at = [], 0
        for size in row["levels"]:
            packed = np.frombuffer(row["bits"], np.uint8, count=-(-size // 8), offset=at)
            bits.append(np.unpackbits(packed)[:size].astype(bool))
            at += -(-size // 8)
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        digests = _matrix(asked["digest"])
        slot = PerfectHash(bits).slots(_keys(digests))
        member = slot >= 0
        member[member] = (held[slot[member]] == digests[member]).all(axis=1)
        slot = slot[member]
        known = np.unpackbits(np.frombuffer(row["known"], np.uint8))[slot].astype(bool)
        winner = np.frombuffer(row["winners"], np.int64)[slot].astype(str).astype(object)
        winner[~known] = None
        out.loc[member, "old_rows"] = np.frombuffer(row["counts"], np.int64)[slot]
        out.loc[member, "old_winner"] = winner
        return out

    asked = _sharded(incoming, shards).select("shard", "digest")
    found = (
        index.groupBy("shard")
        .cogroup(asked.groupBy("shard"))
        .applyInPandas(find, "digest binary, old_rows long, old_winner string")
    )
    return found.withColumn("old_winner", F.col("old_winner").cast("long"))


def exact_dedup(history: DataFrame, incoming: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups the rows of both tables by equal text; see the module for what is returned per row.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, historical.
    """
    rows = staged(
        digest_rows(history, id_col, text_col)
        .withColumn("historical", F.lit(True))
        .unionByName(digest_rows(incoming, id_col, text_col).withColumn("historical", F.lit(False))),
        "digests",
    )
    old = staged(winners(rows.where("historical")), "history")
    new = staged(winners(rows.where("NOT historical")), "incoming")
    shards = max(1, -(-old.count() // SHARD_ROWS))
    index = build_index(old, shards)
    answers = lookup(index, new, shards)
    # Members join their historical group, nonmembers are groups of their own; history nobody asked for stays as it is.
    classes = (
        new.join(answers, "digest")
        .select(
            "digest",
            F.greatest("winner", "old_winner").alias("keep_id"),
            (F.col("n_rows") + F.col("old_rows")).alias("group_size"),
        )
        .unionByName(
            old.join(new.select("digest"), "digest", "left_anti").select(
                "digest", F.col("winner").alias("keep_id"), F.col("n_rows").alias("group_size")
            )
        )
    )
    return rows.join(classes, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "historical",
    )


def split_at_median(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The earlier half of the ids as history, the later half (and rows without an id) as what comes in."""
    pivot = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), 0.5)).first()[0]
    early = F.coalesce(F.col(id_col) <= F.lit(pivot), F.lit(False))
    return docs.where(early), docs.where(~early)
