"""Training-data pipeline: quality, exact copies, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the columns
of ``documents``. Rows may have null or repeated ids; a stage that drops copies keeps one of rows that are equal.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import block_anchors, fourier_quality, mixture_packing, odd_sketch, perfect_hash
from tidemark.llm.common import importable, quoted, staged, table

END_TOKEN = 2


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents but for those in ``dropped``, by id and text."""
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    return docs.join(dropped, (docs["doc_id"].eqNullSafe(dropped["_id"])) & (F.xxhash64(docs["text"]) == dropped["_key"]), "left_anti")


def _own(docs: DataFrame) -> list[Column]:
    """The columns of the documents, whatever their names hold."""
    return [quoted(name) for name in docs.columns]


def _unused(name: str, docs: DataFrame) -> str:
    """The name, made longer until no column has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier, trained on the labelled ones among them, does not reject."""
    scored = fourier_quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 0"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the document with the largest id; of rows that share that id, too, one stays."""
    importable(spark)
    history, incoming = perfect_hash.split_at_median(docs)
    found = perfect_hash.exact_dedup(history, incoming)
    kept = found.where("kept").select("doc_id", F.unhex("text_sha256").alias("digest")).distinct()
    normal = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    digest = _unused("digest", docs)
    rows = docs.select(*_own(docs), F.unhex(F.sha2(normal.cast("binary"), 256)).alias(digest))
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows[digest] == kept["digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*_own(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near copies."""
    importable(spark)
    found = odd_sketch.near_duplicates(docs)
    return _without(docs, found.where("NOT kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages that a document with a smaller id has, too, out of the texts; others stay as they are."""
    importable(spark)
    removed = _unused("words_removed", docs)
    cut = block_anchors.cut_documents(docs, removed=removed)
    if "n_chars" in docs.columns:
        shorter = F.char_length("text").cast("long")
        cut = cut.withColumn("n_chars", F.when(F.col(removed) > 0, shorter).otherwise(F.col("n_chars")))
    return cut.select(*_own(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces that documents are cut into for sequences of 4096 tokens."""
    importable(spark)
    return mixture_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_TOKEN, added_tokens=True)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: No SQL: the classifier is trained, and tokens need a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read by the next."""

    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        return staged(stage[1](spark, docs, sf_dir), stage[0])

    docs = reduce(step, STAGES[:-1], table(spark, sf_dir, "documents"))
    return STAGES[-1][1](spark, docs, sf_dir)
