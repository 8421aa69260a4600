"""WARC archives: a writer with deduplicated payloads and a reader that salvages damaged files.

Writing: every page becomes a record in its own gzip member. Of pages with equal payloads of at least MIN_BYTES the one
with the smallest id is a response, the others are revisit records that refer to it.

Reading: a record counts only if its member inflates with the right checksum, its version line, headers, length and
closing line breaks are in order, and a response has the digest it claims. After a failed check the reader looks for the
next gzip member or version line that passes, goes on from there, and logs the bytes in between as a quarantined gap.
Files are read through a sliding buffer, so memory is bounded by the largest record, not by the file.

Defined results: a null html is an empty payload; payloads below MIN_BYTES are always responses. A null id ranks after
all others; rows that repeat an id and a payload are one page, each is written and none refers to itself. Empty tables
give no files and no records, an empty file neither records nor gaps. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, ranked_id, staged, texts_of
from tidemark.workdir import fresh_dir

MIN_BYTES = 100
#: Compressed bytes after which a task opens its next file.
FILE_BYTES = 16 << 20
CHUNK = 1 << 20
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"


class Damaged(Exception):
    """What is at this place is no whole record."""


class Record(NamedTuple):
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


class Window:
    """A sliding view of a stream by absolute offset."""

    def __init__(self, stream):
        self.stream, self.data, self.start, self.ended = stream, bytearray(), 0, False

    def more(self) -> bool:
        """Reads another chunk; False at the end."""
        if not self.ended:
            chunk = self.stream.read(CHUNK)
            self.ended = not chunk
            self.data += chunk
        return not self.ended

    def peek(self, at: int, n: int) -> bytes:
        while self.start + len(self.data) < at + n and self.more():
            pass
        return bytes(self.data[at - self.start : at - self.start + n])

    def find(self, what: bytes, at: int) -> int:
        """Offset of the next occurrence, -1 if there is none. What was searched stays readable."""
        searched = at
        while True:
            found = self.data.find(what, searched - self.start)
            if found >= 0:
                return self.start + found
            searched = max(at, self.start + len(self.data) - len(what) + 1)
            if not self.more():
                return -1

    def next_start(self, at: int) -> int:
        """The next place that looks like the start of a record, or the end of the stream; lets go of what lies before."""
        while True:
            self.forget(at)
            found = [i for i in (self.data.find(GZIP, at - self.start), self.data.find(VERSION, at - self.start)) if i >= 0]
            if found:
                return self.start + min(found)
            at = max(at, self.start + len(self.data) - len(VERSION) + 1)
            if not self.more():
                return self.start + len(self.data)

    def forget(self, before: int) -> None:
        if before - self.start > CHUNK:
            del self.data[: before - self.start]
            self.start = before


def _parse(raw: bytes) -> tuple[dict[str, str], int]:
    """Headers, with lower-case names, and where the block starts."""
    end = raw.find(END)
    if not raw.startswith(VERSION) or end < 0:
        raise Damaged("no version line or headers")
    try:
        lines = raw[:end].decode("utf-8").split("\r\n")[1:]
        headers = {name.strip().lower(): value.strip() for name, value in (line.split(":", 1) for line in lines)}
        size = int(headers["content-length"])
    except (ValueError, KeyError) as error:
        raise Damaged("headers can't be read") from error
    if size < 0 or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("a required header is missing")
    return headers, end + len(END)


def payload_of(record: Record) -> bytes:
    """The block without the head of its HTTP message."""
    if record.headers.get("content-type", "").startswith("application/http"):
        return record.block.partition(END)[2]
    return record.block


def _claimed(record: Record) -> str:
    """The digest that a response says its payload has, if it can be checked."""
    claimed = record.headers.get("warc-payload-digest", "")
    return claimed[7:].lower() if record.headers["warc-type"] == "response" and claimed.startswith("sha256:") else ""


def _verified(record: Record) -> Record:
    claimed = _claimed(record)
    if claimed and hashlib.sha256(payload_of(record)).hexdigest() != claimed:
        raise Damaged("the payload digest differs")
    return record


class Inflated:
    """The content of a gzip member as a stream that ends where the member ends or breaks off."""

    def __init__(self, window: Window, at: int):
        self.window, self.at, self.here, self.fault = window, at, at, ""
        self.inflate = zlib.decompressobj(31)

    def read(self, _: int) -> bytes:
        while not self.inflate.eof and not self.fault:
            chunk = self.window.peek(self.here, CHUNK >> 4)
            self.here += len(chunk)
            try:
                data = self.inflate.decompress(chunk)
            except zlib.error:
                self.fault = "the member doesn't inflate"
                return b""
            if data:
                return data
            if not chunk:
                self.fault = "the member is cut short"
        return b""

    @property
    def length(self) -> int:
        """Compressed bytes so far; of the whole member once it has ended."""
        return self.here - len(self.inflate.unused_data) - self.at


def _member(window: Window, at: int) -> Iterator[Record | Gap | int]:
    """Records of a member and gaps between them, as they come, and the member's length if it is whole.

    A record that claims no digest waits for the checksum of its member. All have the member's offset; the last piece of a
    whole member has its length, the others none.
    """
    stream = Inflated(window, at)
    inner = Window(stream)
    if inner.peek(0, len(VERSION)) != VERSION:
        raise Damaged(stream.fault or "the member holds no record")
    waiting, gaps, passed = [], [], False
    for found in _walk(inner, members=False):
        if isinstance(found, Gap):
            gaps.append(found)
        elif _claimed(found) and inner.more():
            passed = True
            yield found._replace(offset=at, length=0)
        else:
            waiting.append(found)
    whole = not stream.fault
    kept = [record for record in waiting if whole or _claimed(record)]
    if not whole or not (passed or kept):
        yield from (record._replace(offset=at, length=0) for record in kept)
        raise Damaged(stream.fault or gaps[0].reason)
    pieces = [*kept, *(Gap(at, 0, f"inside a member: {gap.reason}") for gap in gaps)]
    for number, piece in enumerate(pieces, 1):
        yield piece._replace(offset=at, length=stream.length if number == len(pieces) else 0)
    yield stream.length


def _plain(window: Window, at: int) -> Record:
    # Headers end before the next version line: a lost blank line must not make the rest of the file one header.
    size = CHUNK >> 4
    while END not in (head := window.peek(at, size)):
        if VERSION in head[1:] or len(head) < size:
            raise Damaged("headers without an end")
        size *= 2
    headers, body = _parse(head)
    size = int(headers["content-length"])
    raw = window.peek(at + body, size + len(END))
    if len(raw) != size + len(END) or not raw.endswith(END):
        raise Damaged("the length differs")
    return _verified(Record(at, body + size + len(END), headers, raw[:size]))


def salvage(stream) -> Iterator[Record | Gap]:
    """All whole records of a stream in order, and the gaps between them.

    A gzip member may hold any number of records. Of a member that breaks off, those that pass before the break are kept.
    """
    yield from _walk(Window(stream), members=True)


def _walk(window: Window, members: bool) -> Iterator[Record | Gap]:
    at, gap, why = 0, -1, ""
    while start := window.peek(at, len(VERSION)):
        try:
            if members and start.startswith(GZIP):
                found = _member(window, at)
            elif start == VERSION:
                record = _plain(window, at)
                found = iter((record, record.length))
            else:
                raise Damaged("neither a member nor a version line" if members else "no version line")
            for part in found:
                if isinstance(part, int):
                    at += part
                    window.forget(at)
                    continue
                if gap >= 0:
                    yield Gap(gap, at - gap, why)
                    gap = -1
                yield part
        except Damaged as error:
            if gap < 0:
                gap, why = at, str(error)
            at = window.next_start(at + 1)
    if gap >= 0:
        yield Gap(gap, at - gap, why)


def _head(kind: str, page: str, url: str, digest: str, refers_to: str | None, block: int) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-page:{page}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {block}",
    ]
    if refers_to is not None:
        lines[2:2] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:x-page:{refers_to}>",
        ]
    return "\r\n".join(lines).encode() + END


def member(page: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit keeps the head of the HTTP message, which states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    url = " ".join(url.split())
    head = _head(kind, page, url, hashlib.sha256(payload).hexdigest(), refers_to, len(block))
    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
    return deflate.compress(head + block + END) + deflate.flush()


def with_originals(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, url, html and ``refers_to``, the page whose payload this one repeats."""
    url = F.col("url") if "url" in pages.columns else F.lit("")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(url.cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.unhex(F.sha2("html", 256)))
    # Copies are combined before the shuffle; the large side of the join may be split where a payload is frequent.
    first = (
        rows.where(F.octet_length("html") >= MIN_BYTES)
        .groupBy("digest")
        .agg(F.min(ranked_id("page_id")).alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    repeats = F.col("first_id") < ranked_id("page_id")
    return rows.join(first, "digest", "left").select("page_id", "url", "html", F.when(repeats, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Writes the pages below ``root`` and returns path and number of records of every file of the tasks that succeeded.

    ``root`` is a URI that pyarrow's file systems know (local, HDFS, S3). Files have names of their own, so a task that
    runs again leaves an unlisted file at worst.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = FileSystem.from_uri(root)
        out, path, size, n = None, "", 0, 0
        done = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
            for page, url, refers_to, payload in zip(*columns, texts_of(batch, "html"), strict=True):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    path, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                data = member("null" if page is None else str(page), url, payload, None if refers_to is None else str(refers_to))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_pydict(
            {"path": [p for p, _ in done], "n_records": [n for _, n in done]},
            schema=pa.schema([("path", pa.string()), ("n_records", pa.int64())]),
        )

    rows = with_originals(pages, id_col, html_col)
    return staged(rows.mapInArrow(run, "path string, n_records long"), "archives")


RECORDS = (
    "path string, offset long, length long, gap string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(files: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """One row per record and per quarantined gap (``gap`` says why) of the files in ``path``.

    Digest and length are those of the full payload: computed for a record that holds it, as stated for a revisit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = FileSystem.from_uri(root)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if path is None or system.get_file_info(path).type != FileType.File:
                    raise FileNotFoundError(f"no archive at {path}")
                rows: list[dict] = []
                with system.open_input_stream(path, compression=None) as stream:
                    for found in salvage(stream):
                        rows.append({"path": path} | _row(found, payloads))
                        if len(rows) >= 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=ROWS)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=ROWS)

    # A file is the unit of work: deal them out one by one.
    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, RECORDS)


ROWS = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string())]
    + [(n, pa.string()) for n in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def _row(found: Record | Gap, payloads: bool) -> dict:
    if isinstance(found, Gap):
        return {"offset": found.offset, "length": found.length, "gap": found.reason}
    headers, payload = found.headers, payload_of(found)
    row = {"offset": found.offset, "length": found.length, "record_type": headers["warc-type"]}
    row |= {"record_id": headers["warc-record-id"], "target_uri": headers.get("warc-target-uri")}
    if headers["warc-type"] == "revisit":
        stated = [x for x in found.block.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        row |= {"refers_to": headers.get("warc-refers-to"), "payload_digest": headers.get("warc-payload-digest", "")[7:]}
        row["payload_bytes"] = int(stated[0].split(b":")[1]) if stated else None
    else:
        row |= {"payload_digest": hashlib.sha256(payload).hexdigest(), "payload_bytes": len(payload)}
        row["payload"] = payload if payloads else None
    return row


def page_records(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives in the shared folder, reads them back and returns what the records say of each page."""
    root = fresh_dir(pages.sparkSession, "warc")
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    records = read_archives(write_archives(pages, root), root).where("gap IS NULL")
    number = lambda name: F.expr(f"try_cast(regexp_extract({name}, 'x-page:(-?[0-9]+)', 1) AS BIGINT)")
    refers = number("refers_to")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(refers != LAST_ID, refers).alias("refers_to"),
    )
