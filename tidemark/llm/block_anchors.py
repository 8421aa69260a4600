"""Removal of word sequences that repeat across documents, found by fixed-block anchors.

Every document is indexed by its non-overlapping blocks of BLOCK words; every rolling window of BLOCK words is a probe.
A repeat of WINDOW = 2 * BLOCK words holds at least one whole block of the earlier document, so some probe of the later
one hits it. Hits are extended: the windows of WINDOW words around a block and around the probes that hit it are
compared, and the run of windows that also start in a document with a smaller id is the maximal exact repeat.

Probes travel as four bytes of hash and a place, packed by chunk and bucket; what equals an earlier place of the same
chunk is answered there. No task gathers pairs: a bucket keeps the smallest id for each hash.

Defined results: a null text has no words. A null id ranks after all others; documents of equal (or no) id don't remove
words from one another, so a repeated row gets the same result again. Empty tables give no rows; other columns are not
looked at. Words are compared by 64-bit hashes, sequences by hashes of these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.chunks import (
    PACKED_DDL,
    Chunk,
    by_bucket,
    chunked,
    dealt,
    low_bytes,
    one_by_one,
    opened,
    pack,
    packed,
    spans_of,
    unpack,
    with_answers,
)
from tidemark.llm.common import quoted, shuffle_width
from tidemark.llm.words import rolling, within, word_hashes

BLOCK = 25
WINDOW = 2 * BLOCK
#: Bytes of a block's hash that travel; with the bucket they leave a few chance hits in a million, which extension refuses.
HASH_BYTES = 4
HASH = f"u{HASH_BYTES}"
#: Text worked on at a time.
STEP = 1 << 19


def _words(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every n words of the chunk, where a document has that many, and the documents' word offsets."""
    hashes, counts = [], []
    for a, b in chunk.groups(STEP):
        found, offsets = word_hashes(chunk.data[chunk.offsets[a] : chunk.offsets[b]], chunk.offsets[a : b + 1] - chunk.offsets[a])
        hashes.append(found)
        counts.append(np.diff(offsets))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(1, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    rolled = rolling(np.concatenate(hashes), n, n)
    return rolled, within(offsets, n, int(offsets[-1]))[: len(rolled)], offsets


def _gaps(places: np.ndarray) -> np.ndarray:
    """Ascending places as differences, whose upper bytes are zero."""
    return np.diff(places, prepend=0).astype("<u4")


def _send_blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for key, chunk, _ in opened(batch):
                hashes, whole, offsets = _words(chunk, BLOCK)
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                row = np.searchsorted(offsets, at, side="right") - 1
                block = (at - offsets[row]) % BLOCK == 0
                out = []
                for bucket, some in by_bucket(hashes[at] % np.uint64(buckets), buckets):
                    own, first = at[some], block[some]
                    # The bucket is known, so the hash travels without what gave it.
                    h = low_bytes(hashes[own] // np.uint64(buckets), HASH_BYTES)
                    if first.any():
                        out.append((bucket, key, "block", pack(h[first], _gaps(own[first]), chunk.ids[row[some][first]].astype("<i8"))))
                    if not first.all():
                        out.append((bucket, key, "probe", pack(h[~first], _gaps(own[~first]))))
                yield packed(out)

    return run


HIT = ("u4", "i8")
#: In place of a smaller id: the block is needed, whoever hit it.
NEEDED = -(2**63)


def _find_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to chunks: places whose words equal a block elsewhere, and the smallest id that has such a block."""
    parts: dict[str, list] = {"block": [], "probe": []}
    for batch in batches:
        names = ("bucket", "chunk", "kind")
        for bucket, key, kind, payload in zip(*(batch.column(c).to_pylist() for c in names), batch.column("payload"), strict=True):
            columns = unpack(payload.as_py(), *((HASH, "u4", "i8") if kind == "block" else (HASH, "u4")))
            columns[0] = columns[0].astype(np.uint64) | np.uint64(bucket << 8 * HASH_BYTES)
            columns[1] = np.cumsum(columns[1], dtype=np.int64)
            parts[kind].append((key, columns))
    if not parts["block"]:
        return
    hashes = np.concatenate([c[0] for _, c in parts["block"]])
    ids = np.concatenate([c[2] for _, c in parts["block"]])
    index, group = np.unique(hashes, return_inverse=True)
    smallest = np.full(len(index), 2**63 - 1, np.int64)
    np.minimum.at(smallest, group, ids)
    seen = np.bincount(group, minlength=len(index))
    # Most probes hit nothing: a small table of hash ends tells so without a search.
    size = 1 << max(10, int(len(index)).bit_length() + 4)
    table = np.zeros(size, bool)
    table[index & np.uint64(size - 1)] = True
    hits = []
    for key, (h, at) in parts["probe"]:
        maybe = np.flatnonzero(table[h & np.uint64(size - 1)])
        place = np.searchsorted(index, h[maybe])
        place[place == len(index)] = 0
        found = index[place] == h[maybe]
        place, maybe = place[found], maybe[found]
        seen += np.bincount(place, minlength=len(index))
        if len(maybe):
            hits.append((key, at[maybe], smallest[place]))
    start = 0
    for key, (h, at, _) in parts["block"]:
        own = group[start : start + len(h)]
        start += len(h)
        used = seen[own] > 1
        if used.any():
            hits.append((key, at[used], np.full(int(used.sum()), NEEDED, np.int64)))
    for key, at, least in hits:
        yield packed([(0, key, "hit", pack(at.astype("<u4"), least.astype("<i8")))])


RUN = ("u4", "u4")


def _runs(places: np.ndarray) -> bytes:
    """Ascending window starts as (start, number)."""
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return pack(places[first].astype("<u4"), np.diff(np.append(first, len(places))).astype("<u4"))


def _send_windows(buckets: int):
    """Extends hits: the windows around each, answered within the chunk where an earlier document has them too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for key, chunk, answers in opened(batch):
                if not answers:
                    continue
                at, least = (np.concatenate(x) for x in zip(*(unpack(a, *HIT) for a in answers), strict=True))
                at = at.astype(np.int64)
                hashes, whole, offsets = _words(chunk, WINDOW)
                row = np.searchsorted(offsets, at, side="right") - 1
                at = np.unique(at[(least < chunk.ids[row]) | (least == NEEDED)])
                # Of the windows that hold a block each belongs to the first whole block in it.
                near = np.zeros(int(offsets[-1]) + 1, np.int64)
                np.add.at(near, np.maximum(at - BLOCK + 1, 0), 1)
                np.add.at(near, at + 1, -1)
                window = np.flatnonzero((np.cumsum(near[:-1])[: len(whole)] > 0) & whole)
                if not len(window):
                    continue
                row = np.searchsorted(offsets, window, side="right") - 1
                h, ids = hashes[window], chunk.ids[row]
                order = np.lexsort((ids, h))
                new = np.concatenate([[True], np.diff(h[order]) != 0])
                smallest = np.empty(len(order), np.int64)
                smallest[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
                later = ids > smallest
                out = []
                if later.any():
                    out.append((key % buckets, key, "run", _runs(window[later])))
                h, window, ids = h[~later], window[~later], ids[~later]
                for bucket, some in by_bucket(h % np.uint64(buckets), buckets):
                    data = pack(h[some].astype("<u8"), _gaps(window[some]), ids[some].astype("<i8"))
                    out.append((bucket, key, "window", data))
                yield packed(out)

    return run


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, keys = [], []
    for batch in batches:
        for key, kind, payload in zip(batch.column("chunk").to_pylist(), batch.column("kind").to_pylist(), batch.column("payload"), strict=True):
            if kind == "run":
                yield packed([(0, key, "run", payload.as_py())])
            else:
                h, gaps, ids = unpack(payload.as_py(), "u8", "u4", "i8")
                parts.append((h, np.cumsum(gaps, dtype=np.int64), ids))
                keys.append(key)
    if not parts:
        return
    hashes = np.concatenate([p[0] for p in parts])
    ids = np.concatenate([p[2] for p in parts])
    order = np.argsort(hashes, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
    least = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.append(starts, len(order))))
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > least
    at = 0
    for key, (h, window, _) in zip(keys, parts, strict=True):
        own = window[later[at : at + len(h)]]
        at += len(h)
        if len(own):
            yield packed([(0, key, "run", _runs(own))])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """The documents as chunks, answered by runs of windows to remove."""
    buckets = shuffle_width(docs.sparkSession)
    chunks = chunked(docs, id_col, text_col, keep=keep)
    bare = chunks.drop("rest")
    hits = dealt(bare.mapInArrow(_send_blocks(buckets), PACKED_DDL)).mapInArrow(_find_hits, PACKED_DDL)
    asked = with_answers(chunks, hits).mapInArrow(_send_windows(buckets), PACKED_DDL)
    return with_answers(chunks, dealt(asked).mapInArrow(_find_runs, PACKED_DDL))


def _cut(chunk: Chunk, answers: list[bytes]) -> Iterator[tuple[bytes, list[bytes], list[tuple[int, int]], list[bytes]]]:
    """Text, words, removed spans of words and kept words of every document of an answered chunk."""
    runs = [unpack(a, *RUN) for a in answers] or [[np.zeros(0, "<u4")] * 2]
    first, n = (np.concatenate(x).astype(np.int64) for x in zip(*runs, strict=True))
    order = np.argsort(first, kind="stable")
    first, end = first[order], (first + n + WINDOW - 1)[order]
    before = 0
    for i in range(len(chunk)):
        text = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes()
        words = text.split()
        a, b = np.searchsorted(first, [before, before + len(words)])
        spans = list(zip(*(z.tolist() for z in spans_of(first[a:b] - before, end[a:b] - before)), strict=True))
        before += len(words)
        kept, at = [], 0
        for x, y in spans:
            kept += words[at:x]
            at = y
        yield text, words, spans, kept + words[at:]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document.

    With ``texts`` also the removed spans of words and ``kept``, the words that stay, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for _, chunk, answers in opened(batch):
                rows = []
                for i, (_, words, spans, kept) in enumerate(_cut(chunk, answers)):
                    joined = b" ".join(kept)
                    row = {
                        "doc_id": int(chunk.ids[i]) if chunk.known[i] else None,
                        "n_words": len(words),
                        "n_removed": len(words) - len(kept),
                        "kept_sha256": hashlib.sha256(joined).hexdigest(),
                    }
                    if texts:
                        row |= {"starts": [x for x, _ in spans], "ends": [y for _, y in spans], "kept": joined.decode()}
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = [("doc_id", pa.int64(), "long"), ("n_words", pa.int64(), "long"), ("n_removed", pa.int64(), "long")]
    kinds += [("kept_sha256", pa.string(), "string")]
    if texts:
        kinds += [("starts", pa.list_(pa.int64()), "array<long>"), ("ends", pa.list_(pa.int64()), "array<long>")]
        kinds += [("kept", pa.string(), "string")]
    schema = pa.schema([(n, t) for n, t, _ in kinds])
    return repeated_runs(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{n} {t}" for n, _, t in kinds))


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "words_removed") -> DataFrame:
    """All columns of the documents with the repeats taken out of their texts, and how many words were ``removed``.

    Texts without repeats stay as they are, others become their kept words, joined by one space.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for _, chunk, answers in opened(batch):
                rest = chunk.rest().combine_chunks()
                texts, gone = [], []
                for null, (text, words, _, kept) in zip(rest.column(0).to_pylist(), _cut(chunk, answers), strict=True):
                    gone.append(len(words) - len(kept))
                    texts.append(None if null else (b" ".join(kept) if gone[-1] else text).decode())
                ids = pa.array(chunk.ids, pa.int64(), mask=~chunk.known)
                kept_columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rest.columns[1:]]
                kept_columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in kept_columns]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(texts, pa.string()), pa.array(gone, pa.int64()), *kept_columns],
                    ["_id", "_text", "words_removed", *(f"_{i}" for i in range(len(others)))],
                )

    null = F.col(text_col).isNull().alias("null")
    keep = F.struct(null, *[quoted(c).alias(f"_{i}") for i, c in enumerate(others)])
    schema = StructType([StructField("_id", LongType()), StructField("_text", StringType()), StructField("words_removed", LongType())])
    schema = StructType([*schema, *(StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(others))])
    found = repeated_runs(docs, id_col, text_col, keep).mapInArrow(run, schema)
    place = {id_col: "_id", text_col: "_text"} | {c: f"_{i}" for i, c in enumerate(others)}
    return found.select(*[F.col(place[c]).alias(c) for c in docs.columns], F.col("words_removed").alias(removed))
