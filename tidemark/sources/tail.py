"""Growing log files as a stream: every complete line once, also after a rotation by renaming.

The offset of a file is where its last complete line ends. A file is known by its first bytes, which appending never
changes: under its own name first, else under a new one. The registry, a JSON file beside the checkpoint, keeps what a file
was first called, so that its lines keep one name, and its first bytes; offsets hold no more than ends and days. Only
listings and first bytes pass through the driver; tasks read the bytes between two offsets, long ranges in pieces, short
ones many to a task. Work per file does not depend on how many files there are.

Paths are those that pyarrow's file systems open from every executor: local to all, HDFS, or an object store.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# First bytes that a file is known by, bytes that a task reads, and bytes looked through at a time for a line's end.
HEAD = 1_024
RANGE = 64 << 20
STEP = 1 << 20
# Bytes that could be read while a file is opened, as Spark's openCostInBytes, and files that the driver opens at a time.
OPENING = 256 << 10
AT_ONCE = 16
LINES = "message string, file string, position long, arrived int"


class Seen(NamedTuple):
    """A file as it was listed: where it is, where its last complete line ends, its first bytes, the day of its last change."""

    path: str
    end: int
    head: str
    day: int


def same_files(known: dict[str, Seen], listed: list[Seen]) -> dict[str, Seen]:
    """Listed files under the names they are known by; files that are new get their path, or path and number.

    A file continues a known one if it begins with that one's first bytes and is no shorter: first of all the one at the
    same place, then, as renamed, others that no file continues yet. Empty files are known by their place only.
    """
    continues = lambda new, old: new.end >= old.end and (new.head.startswith(old.head) if old.head else new.path == old.path)
    by_path = {old.path: name for name, old in known.items()}
    found, rest = {}, []
    for new in sorted(listed):
        name = by_path.get(new.path)
        if name is not None and continues(new, known[name]):
            found[name] = new
        else:
            rest.append(new)
    # Files that none continues yet by their first bytes, shortest first; of equally long ones the first known is the last.
    lost = defaultdict(list)
    for order, (name, old) in enumerate(known.items()):
        if name not in found and old.head:
            insort(lost[old.head], (old.end, -order, name))
    lengths = sorted({len(head) for head in lost})
    for new in rest:
        moved = []
        for length in lengths:
            same = lost.get(new.head[:length]) if length <= len(new.head) else None
            if same and (at := bisect_right(same, new.end, key=lambda old: old[0])):
                moved.append((same[at - 1], same, at - 1))
        if moved:
            (_, _, name), same, at = max(moved, key=lambda m: m[0])
            del same[at]
        else:
            number, name = 2, new.path
            while name in found or name in known:
                name, number = f"{new.path}#{number}", number + 1
        found[name] = new
    return found


class Piece(NamedTuple):
    """Bytes of a file that a task has: of the lines from ``start`` to ``end`` those that begin in ``first`` to ``last``.

    ``size`` and ``digest`` tell the first bytes of the file.
    """

    name: str
    path: str
    size: int
    digest: str
    day: int
    start: int
    end: int
    first: int
    last: int


class Pieces(InputPartition):
    def __init__(self, pieces: list[Piece]):
        self.pieces = [tuple(piece) for piece in pieces]


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, pattern: str, registry: str, step: int, tasks: int):
        self.path, self.pattern, self.registry, self.step, self.tasks = path, pattern, registry, step, tasks

    def _listed(self) -> list[Seen]:
        system, root = fs.FileSystem.from_uri(self.path)

        def seen(info: fs.FileInfo) -> Seen:
            with system.open_input_file(info.path) as file:
                end = _last_line(file, info.size)
                return Seen(info.path, end, file.read_at(min(end, HEAD), 0).hex() if end else "", int(info.mtime.timestamp() // 86_400))

        there = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(seen, [i for i in there if i.type == fs.FileType.File and fnmatch(i.base_name, self.pattern)]))

    def _known(self) -> dict[str, Seen]:
        system, place = fs.FileSystem.from_uri(self.registry)
        if system.get_file_info(place).type != fs.FileType.File:
            return {}
        with system.open_input_stream(place) as file:
            return {name: Seen(*seen) for name, seen in json.loads(file.read()).items()}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, place = fs.FileSystem.from_uri(self.registry)
        now = same_files(self._known(), self._listed())
        text = json.dumps(now)
        # Complete before it takes the old one's place.
        with system.open_output_stream(f"{place}.new") as file:
            file.write(text.encode())
        system.move(f"{place}.new", place)
        return {name: f"{seen.end},{seen.day}" for name, seen in now.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # Later listings keep a file's name and first bytes, so the registry serves offsets that are older, too.
        known, pieces = self._known(), []
        for name, text in end.items():
            (begin, _), (until, day) = _offset(start.get(name, "0,0")), _offset(text)
            if begin < until:
                if name not in known:
                    raise FileNotFoundError(f"{name} is gone, with lines that were not read")
                path, _, head, _ = known[name]
                first = bytes.fromhex(head)
                about = name, path, len(first), sha256(first).hexdigest(), day, begin, until
                pieces += [Piece(*about, at, min(at + self.step, until)) for at in range(begin, until, self.step)]
        # As many pieces to a task as one may read, but work for all tasks that can run at a time.
        cost = [piece.last - piece.first + OPENING for piece in pieces]
        most = min(self.step, max(OPENING, sum(cost) // self.tasks))
        bundles, left = [], 0
        for piece, bytes_ in zip(pieces, cost):
            if bytes_ > left:
                bundles.append([])
                left = most
            bundles[-1].append(piece)
            left -= bytes_
        return [Pieces(bundle) for bundle in bundles]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(self.path)
        others = None
        for piece in (Piece(*piece) for piece in partition.pieces):
            # The file may have been renamed since it was listed. The folder is listed again for that only, once a task.
            path = piece.path
            if not _holds(system, system.get_file_info(path), piece):
                if others is None:
                    others = [i for i in system.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.File]
                path = next((i.path for i in others if _holds(system, i, piece)), None)
                if path is None:
                    raise FileNotFoundError(f"{piece.path} is gone, with lines that were not read")
            yield _lines(system, path, piece)


def _offset(text: str) -> tuple[int, int]:
    """Where the last complete line ends and the day of the last change; earlier versions wrote all of ``Seen``."""
    if text.startswith("["):
        seen = Seen(*json.loads(text))
        return seen.end, seen.day
    end, day = text.split(",")
    return int(end), int(day)


def _holds(system: fs.FileSystem, info: fs.FileInfo, piece: Piece) -> bool:
    """Whether this is the file that the piece is of."""
    if info.type != fs.FileType.File or info.size < piece.end:
        return False
    with system.open_input_file(info.path) as file:
        return sha256(file.read_at(piece.size, 0)).hexdigest() == piece.digest


def _lines(system: fs.FileSystem, path: str, piece: Piece) -> pa.RecordBatch:
    with system.open_input_file(path) as file:
        first = piece.first if piece.first == piece.start else _next_line(file, piece.first - 1, piece.end)
        last = piece.last if piece.last == piece.end else _next_line(file, piece.last - 1, piece.end)
        data = file.read_at(last - first, first) if last > first else b""
    lines = data.split(b"\n")[:-1]
    positions, at = [], first
    for line in lines:
        positions.append(at)
        at += len(line) + 1
    n = len(lines)
    columns = [
        pa.array([line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines], pa.string()),
        pa.array([piece.name] * n, pa.string()),
        pa.array(positions, pa.int64()),
        pa.array([piece.day] * n, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["message", "file", "position", "arrived"])


def _last_line(file: pa.NativeFile, size: int) -> int:
    """Where the last complete line ends."""
    end = size
    while end > 0:
        start = max(0, end - STEP)
        found = file.read_at(end - start, start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    return 0


def _next_line(file: pa.NativeFile, at: int, end: int) -> int:
    """The first line that begins behind a place."""
    while at < end:
        found = file.read_at(min(STEP, end - at), at).find(b"\n")
        if found >= 0:
            return at + found + 1
        at += STEP
    return end


class TailSource(DataSource):
    """``spark.readStream.format("log_tail")``: options path, pattern, registry, bytesPerTask and tasks, which run at a time."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> TailReader:
        given = self.options
        step, tasks = int(given.get("bytesPerTask", RANGE)), int(given.get("tasks", 1))
        return TailReader(_uri(given["path"]), given.get("pattern", "*"), _uri(given["registry"]), step, tasks)


def _uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def tail_log_lines(
    spark: SparkSession, path: str, registry: str, pattern: str = "*.log*", service: str = "airflow", log_type: str = "dag_logs",
    bytes_per_task: int = RANGE,
) -> DataFrame:
    """Lines as they are appended to the files below ``path``, with their tags.

    ``registry`` is a file of this stream alone and belongs to its checkpoint: losing it means reading all files again.
    ``position`` is a line's place in its file. What is appended between a listing and the removal of a file is lost.
    """
    # The source goes to the workers as it is here, wherever they import the package from.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TailSource)
    options = {"bytesPerTask": bytes_per_task, "tasks": spark.sparkContext.defaultParallelism}
    lines = spark.readStream.format("log_tail").options(path=path, pattern=pattern, registry=registry, **options).load()
    return lines.select(
        "message",
        F.lit(service).alias("service"),
        F.lit(log_type).alias("log_type"),
        "file",
        F.floor(F.col("position") / bytes_per_task).alias("block"),
        F.col("position").alias("at"),
        F.date_from_unix_date("arrived").alias("arrived"),
    )
