"""A corpus in large rows: many documents in one compressed block, so that later steps move few rows.

Steps that compare positions across documents send small packed arrays to buckets and get packed answers back by chunk.
A document lies whole in one chunk, however long it is, and is known by its row there: repeated and missing ids need no
care. Chunks are written once; a lost executor never changes which documents a chunk holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, bytes_of, shuffle_width, staged

#: Bytes of text in a chunk, unless a single document is longer.
CHUNK_BYTES = 8 << 20
#: Compression of chunks, which are written and shuffled.
LEVEL = 3

PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.string()), ("payload", pa.binary())])
PACKED_DDL = "bucket int, chunk long, kind string, payload binary"


class Chunk:
    """The documents of a chunk.

    ids (a missing one ranks last), which ids are known, all bytes with n + 1 offsets, and the columns that were kept.
    """

    def __init__(self, ids: np.ndarray, known: np.ndarray, offsets: np.ndarray, data: np.ndarray, rest: bytes | None = None):
        self.ids, self.known, self.offsets, self.data, self._rest = ids, known, offsets, data, rest

    def rest(self) -> pa.Table:
        return pa.ipc.open_stream(self._rest).read_all()

    def __len__(self) -> int:
        return len(self.ids)

    def groups(self, size: int) -> Iterator[tuple[int, int]]:
        """Ranges of documents of about ``size`` bytes, which keeps temporary arrays small."""
        start = 0
        while start < len(self):
            end = int(np.searchsorted(self.offsets, self.offsets[start] + size, side="right")) - 1
            end = min(max(end, start + 1), len(self))
            yield start, end
            start = end


def chunked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK_BYTES, keep: Column | None = None
) -> DataFrame:
    """The documents as chunks in the shared folder; a null text is empty. ``keep``: a struct that goes along."""
    keeps = keep is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        press = zstandard.ZstdCompressor(level=LEVEL)
        ids, known, sizes, parts, rest, held, n = [], [], [], [], [], 0, 0

        def others() -> bytes | None:
            if not keeps:
                return None
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rest[0].schema) as stream:
                for part in rest:
                    stream.write_batch(part)
            return press.compress(out.getvalue())

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([base + n], pa.int64()),
                    "ids": [np.concatenate(ids).tobytes()],
                    "known": [np.packbits(np.concatenate(known)).tobytes()],
                    "sizes": [np.concatenate(sizes).tobytes()],
                    "body": [press.compress(b"".join(parts))],
                    "rest": pa.array([others()], pa.binary()),
                }
            )

        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            id_array = batch.column("doc_id")
            values = id_array.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            there = id_array.is_valid().to_numpy(zero_copy_only=False)
            start = 0
            while start < len(values):
                end = int(np.searchsorted(offsets, offsets[start] + max(1, size - held), side="right")) - 1
                end = min(max(end, start + 1), len(values))
                ids.append(values[start:end])
                known.append(there[start:end])
                sizes.append(np.diff(offsets[start : end + 1]))
                parts.append(data[offsets[start] : offsets[end]].tobytes())
                if keeps:
                    rest.append(pa.RecordBatch.from_struct_array(batch.column("rest").slice(start, end - start)))
                held += len(parts[-1])
                start = end
                if held >= size or len(ids) >= 4096 or start < len(values):
                    yield block()
                    ids, known, sizes, parts, rest, held, n = [], [], [], [], [], 0, n + 1
        if ids:
            yield block()

    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    rows = docs.select(*columns, *([] if keep is None else [keep.alias("rest")]))
    return staged(rows.mapInArrow(run, "chunk long, ids binary, known binary, sizes binary, body binary, rest binary"), "chunks")


def opened(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk, list[bytes]]]:
    """Key, documents and answers (if there are any) of every chunk of a batch."""
    names = batch.schema.names
    unpress = zstandard.ZstdDecompressor()
    for i in range(batch.num_rows):
        get = lambda name: batch.column(name)[i].as_py()  # noqa: B023, E731
        ids = np.frombuffer(get("ids"), np.int64)
        known = np.unpackbits(np.frombuffer(get("known"), np.uint8))[: len(ids)].astype(bool)
        offsets = np.concatenate([[0], np.cumsum(np.frombuffer(get("sizes"), np.int64))])
        data = np.frombuffer(unpress.decompress(get("body")), np.uint8)
        answers = (get("answers") or []) if "answers" in names else []
        rest = get("rest") if "rest" in names else None
        yield batch.column("chunk")[i].as_py(), Chunk(ids, known, offsets, data, rest and unpress.decompress(rest)), answers


def dealt(rows: DataFrame) -> DataFrame:
    """Packed rows brought together by bucket: bucket b goes to partition b."""
    return rows.repartitionById(shuffle_width(rows.sparkSession), F.col("bucket"))


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with the payloads that answer them. Answers to a chunk are bounded by what it holds."""
    spark = chunks.sparkSession
    own = chunks.repartition(shuffle_width(spark), "chunk")
    gathered = answers.groupBy("chunk").agg(F.collect_list("payload").alias("answers"))
    return own.join(gathered, "chunk", "left")


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def packed(rows: Sequence[tuple[int, int, str, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PACKED.types, strict=True)], schema=PACKED)


def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers as byte planes, which compress well; the types are agreed on by the reader."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def unpack(data: bytes, *types: str) -> list[np.ndarray]:
    """What ``pack`` packed. A type like ``u5`` is the low five bytes of an unsigned 64-bit number."""
    widths = [int(t[1:]) for t in types]
    n, at, out = len(data) // sum(widths), 0, []
    for kind, width in zip(types, widths, strict=True):
        plane = np.frombuffer(data, np.uint8, count=n * width, offset=at).reshape(width, n).T
        at += n * width
        if width in (1, 2, 4, 8):
            out.append(np.ascontiguousarray(plane).view(f"<{kind}").ravel())
        else:
            full = np.zeros((n, 8), np.uint8)
            full[:, :width] = plane
            out.append(full.view("<u8").ravel())
    return out


def low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of 64-bit numbers as rows, for ``pack``."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def by_bucket(buckets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket and the places of its entries, in order."""
    kind = np.uint16 if n <= 65_536 else np.uint32
    order = np.argsort(buckets.astype(kind), kind="stable")
    ends = np.cumsum(np.bincount(buckets.astype(np.int64), minlength=n))
    for b in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        yield b, order[ends[b - 1] if b else 0 : ends[b]]


def spans_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal runs, in order; runs that touch are one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]


def spans_by_row(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> Callable[[int], tuple[np.ndarray, np.ndarray]]:
    """Looks up the merged intervals of a document by its row."""
    order = np.argsort(row, kind="stable")
    row, start, end = row[order], start[order], end[order]

    def of(i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(row, [i, i + 1])
        return spans_of(start[a:b].astype(np.int64), end[a:b].astype(np.int64))

    return of
