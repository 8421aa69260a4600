"""Quality scores from random Fourier features of document statistics.

One pass computes statistics of every whole text: shares of character classes, word and line shapes, repetition. They
are standardised; cosines of random projections approximate a Gaussian kernel. Ridge weights come from normal equations
that every partition sums for itself; only those sums, whose size depends on the number of features alone, are added
up. Isotonic regression over scores of rows that the weights haven't seen makes probabilities of them.

Defined results: a null text is empty and is scored like any other; rows are scored one by one, so repeated rows get
equal scores. A label that is null is not learned from; a document with several labels counts with each. With no
labels, or labels of one kind, every score is the (smoothed) share of good labels, 0.5 without any. A null id is never
held out and carries no label. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, texts_of

FEATURES = [f"f{i:02d}" for i in range(22)]
#: Cosine features; normal equations have (COMPONENTS + 1) squared entries.
COMPONENTS = 256
RIDGE = 1e-3
#: Steps of the score scale on which calibration counts labels.
STEPS = 4_000
SEED = 20240201

# Classes of bytes: 0 other, 1 a-z, 2 A-Z, 3 digits, 4 blanks, 5 line feeds, 6 sentence marks, 7 symbols, 8 beyond ASCII.
CLASSES = np.zeros(256, np.int64)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 8
CLASSES[[32, 9]], CLASSES[[10, 13]] = 4, 5
CLASSES[np.frombuffer(b".,;:'\"()?-", np.uint8)] = 6
CLASSES[np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~", np.uint8)] = 7
SYMBOL_WORD = re.compile(rb"[!#$%&*+/<=>@\[\\\]^_`{|}~]{2}")


def statistics(text: bytes) -> list[float]:
    """The statistics of one text. All are bounded or logarithms, so that no document stretches the scale."""
    data = np.frombuffer(text, np.uint8)
    n = max(1, len(data))
    shares = (np.bincount(CLASSES[data], minlength=9) / n).tolist()
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [x for x in text.split(b"\n") if x]
    k = max(1, len(lines))
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    lower, upper = shares[1], shares[2]
    return [
        *shares,
        math.log1p(len(words)),
        float(lengths.mean()) / (10 + float(lengths.mean())),
        float(lengths.std()) / (10 + float(lengths.std())),
        float(lengths.max()) / (100 + float(lengths.max())),
        distinct / w,
        repeats / w,
        math.log1p(len(lines)) / math.log1p(w + 1),
        1 - len(set(lines)) / k,
        upper / (upper + lower + 1e-3),
        sum(map(bytes.isupper, words)) / w,
        min(1.0, len(SYMBOL_WORD.findall(text)) / w),
        words.count(b"|") / w if words else 0.0,
        math.log1p(w / k) / 10,
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text, which tells rows of equal ids apart) and the statistics of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([statistics(text) for text in texts_of(batch)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(values[:, i]) for i in range(len(FEATURES)))],
                ["doc_id", "text_key", *FEATURES],
            )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, " + ", ".join(f"{f} double" for f in FEATURES))


class Model(NamedTuple):
    """Everything needed to score; a few hundred kB whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """Ridge scores; the statistics are cut at five deviations."""
        return cosines(stats, self.mean, self.scale, self.projection, self.shift) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps, self.values)


def cosines(stats: np.ndarray, mean, scale, projection, shift) -> np.ndarray:
    z = np.clip((stats - mean) / scale, -5, 5)
    features = np.sqrt(2 / len(shift)) * np.cos(z @ projection + shift)
    return np.hstack([features, np.ones((len(z), 1))])


def isotonic(x: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing fit: pool adjacent violators, each pool at the mean of its places."""
    pools: list[list[float]] = []
    for place, good, n in sorted(zip(x.tolist(), positive.tolist(), total.tolist(), strict=True)):
        pools.append([place * n, good, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _stats(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])


def _normal_equations(train: DataFrame, mean, scale, projection, shift) -> tuple[np.ndarray, np.ndarray]:
    """Sums of outer products over all rows: within partitions, then over a fixed number of tasks, then here."""
    size = len(shift) + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                phi = cosines(_stats(batch), mean, scale, projection, shift)
                gram[:, :size] += phi.T @ phi
                gram[:, size] += phi.T @ batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()]}, schema=pa.schema([("gram", pa.binary())]))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros(size * (size + 1))
        for batch in batches:
            for part in batch.column("gram"):
                gram += np.frombuffer(part.as_buffer(), np.float64)
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()]}, schema=pa.schema([("gram", pa.binary())]))

    parts = train.mapInArrow(summed, "gram binary").repartition(4).mapInArrow(added, "gram binary").collect()
    gram = sum((np.frombuffer(r["gram"], np.float64) for r in parts), np.zeros(size * (size + 1)))
    gram = gram.reshape(size, size + 1)
    return gram[:, :size], gram[:, size]


def fit(stats: DataFrame, labels: DataFrame, fold: Column, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Ridge weights from labelled rows of fold 0, calibration from those of fold 2; fold 1 is never looked at."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).dropna()
    rows = staged(stats.withColumn("fold", fold).where("fold <> 1").join(known, "doc_id"), "labelled")
    summary = rows.where("fold = 0").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(f).alias(f"m_{f}") for f in FEATURES),
        *(F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES),
    ).first()
    random = np.random.default_rng(SEED)
    dims = len(FEATURES)
    mean = np.array([summary[f"m_{f}"] or 0.0 for f in FEATURES])
    # A statistic that hardly varies among the labelled rows must not blow up for others.
    scale = np.maximum(np.array([summary[f"s_{f}"] or 0.0 for f in FEATURES]), 0.02)
    projection = random.normal(size=(dims, COMPONENTS)) / math.sqrt(dims)
    shift = random.uniform(0, 2 * math.pi, COMPONENTS)
    gram, target = _normal_equations(rows.where("fold = 0"), mean, scale, projection, shift)
    n = max(1, summary["n"])
    penalty = RIDGE * n * np.eye(COMPONENTS + 1) + 1e-6 * np.eye(COMPONENTS + 1)
    penalty[-1, -1] = 1e-6
    weights = np.linalg.solve(gram + penalty, target)
    model = Model(mean, scale, projection, shift, weights, np.zeros(1), np.zeros(1))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.rint(np.clip(model.raw(_stats(batch)), -1, 2) * STEPS / 3).astype(np.int64) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int64()), batch.column("label")], ["step", "label"])

    # At most STEPS + 1 rows, whatever the corpus.
    counted = (
        rows.where("fold = 2")
        .mapInArrow(placed, "step long, label double")
        .groupBy("step")
        .agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    if not counted:
        prior = (target[-1] + 1) / (gram[-1, -1] + 2)
        return model._replace(values=np.array([prior]))
    x = np.array([r["step"] for r in counted]) * 3 / STEPS
    steps, values = isotonic(x, np.array([r["good"] for r in counted]), np.array([float(r["n"]) for r in counted]))
    return model._replace(steps=steps, values=np.clip(values, 0, 1))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_key and score of every row of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_stats(batch)) if batch.num_rows else np.zeros(0)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "score"])

    return stats.mapInArrow(run, "doc_id long, text_key long, score double")


def fold_of(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3, F.lit(0))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted of every document; learned from labels outside the held-out third."""
    stats = staged(document_statistics(docs), "statistics")
    model = fit(stats, labels, fold_of())
    return score(stats, model).select(
        "doc_id",
        "text_key",
        (fold_of() == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
