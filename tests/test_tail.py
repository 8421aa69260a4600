import glob
import json
import random
import time
from datetime import date

import pytest

from tidemark.sources import tail
from tidemark.sources.tail import Seen, TailReader, same_files, tail_log_lines
from tidemark.streaming import logs

DAY = date(2024, 2, 1)
HEAD = "[2024-01-05T00:00:00.000+0000] {x.py:%d} "


@pytest.fixture
def service(spark, tmp_path):
    """A folder of live logs and a function that runs the stream over what is there now."""
    live = tmp_path / "live"
    live.mkdir()
    path, checkpoint, registry = (str(tmp_path / n) for n in ("records", "cp", "registry.json"))

    def run(**options):
        lines = tail_log_lines(spark, str(live), registry, bytes_per_task=options.pop("bytes_per_task", 64))
        query = logs.tail_to_table(lines, path, checkpoint, DAY, **options)
        query.awaitTermination()
        return query

    def stored():
        return sorted(r["message"] for r in spark.read.parquet(path).select("message").collect()) if glob.glob(f"{path}/log_date=*") else []

    return live, run, stored, (path, checkpoint)


def append(file, text):
    with file.open("a") as out:
        out.write(text)


def test_appended_lines_once_and_events_over_batches(spark, service):
    live, run, stored, (path, checkpoint) = service
    log = live / "a.log"
    append(log, HEAD % 1 + "ERROR - Task failed with exception\nTrace")
    run()
    assert stored() == []
    append(log, "back\n  File y\n")
    run()
    run()
    append(log, HEAD % 2 + "INFO - x\nfree\n")
    run()
    assert stored() == [HEAD % 1 + "ERROR - Task failed with exception\nTraceback\n  File y"]
    # Rotated by renaming, lines appended to the old file before and to the new one after.
    append(log, "more\n")
    log.rename(live / "a.log.1")
    append(log, HEAD % 3 + "INFO - new file\n")
    run()
    logs.close_events(spark, path, checkpoint, DAY)
    logs.close_events(spark, path, checkpoint, DAY)
    assert stored() == [
        HEAD % 1 + "ERROR - Task failed with exception\nTraceback\n  File y",
        HEAD % 2 + "INFO - x\nfree\nmore",
        HEAD % 3 + "INFO - new file",
    ]
    got = spark.read.parquet(path).where("task_status = 'FAILED'").collect()
    assert [(r.log_date, r.exception_trace) for r in got] == [(date(2024, 1, 5), "\nTraceback\n  File y")]


def test_quiet_files_and_long_events_do_not_wait_for_ever(service):
    live, run, stored, _ = service
    append(live / "quiet.log", HEAD % 1 + "INFO - last words\n")
    for i in range(4):
        append(live / "busy.log", f"line {i}\n" * 10)
        run(idle_batches=2, most_open_lines=25)
    assert HEAD % 1 + "INFO - last words" in stored()
    assert "\n".join(f"line {i}" for i in range(3) for _ in range(10)) in stored()


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    path, waiting = str(tmp_path / "records"), str(tmp_path / "open")
    rows = [(HEAD % 1 + "a", "s", "l", "f", 0, 0, DAY), ("b", "s", "l", "f", 0, 50, DAY), (HEAD % 2 + "c", "s", "l", "f", 0, 60, DAY)]
    ddl = "message string, service string, log_type string, file string, block bigint, at bigint, arrived date"
    write = logs.tail_writer(path, waiting, DAY)
    for number, part in ((0, rows[:1]), (0, rows[:1]), (1, rows[1:]), (1, rows[1:])):
        write(spark.createDataFrame(part, ddl), number)
    assert [r["message"] for r in spark.read.parquet(path).collect()] == [HEAD % 1 + "a\nb"]
    assert [r["message"] for r in spark.read.parquet(f"{waiting}/batch=1").collect()] == [HEAD % 2 + "c"]


def test_files_are_known_by_their_first_bytes():
    a, b = Seen("a.log", 10, "aa", 1), Seen("b.log", 5, "bb", 1)
    known = {"a.log": a, "b.log": b}
    # Grown in place; renamed and grown while another took its place; truncated after a copy; a copy of a file that is still there.
    assert same_files(known, [a._replace(end=20, head="aacc"), b]) == {"a.log": a._replace(end=20, head="aacc"), "b.log": b}
    moved, fresh = Seen("a.log.1", 12, "aacc", 2), Seen("a.log", 3, "dd", 2)
    assert same_files(known, [moved, fresh, b]) == {"a.log": moved, "a.log#2": fresh, "b.log": b}
    assert same_files(known, [Seen("a.log", 0, "", 2), Seen("a.log.1", 10, "aa", 1)])["a.log"].path == "a.log.1"
    assert same_files(known, [a, a._replace(path="z.log")]) == {"a.log": a, "z.log": a._replace(path="z.log")}
    # Two files that begin alike stay apart by their places.
    twins = {"x": Seen("x", 4, "ee", 1), "y": Seen("y", 8, "ee", 1)}
    assert same_files(twins, [Seen("x", 9, "eeff", 1), Seen("y", 9, "ee00", 1)]) == {"x": Seen("x", 9, "eeff", 1), "y": Seen("y", 9, "ee00", 1)}


def continued(known, listed):
    """``same_files`` by comparing every file with every known one."""
    continues = lambda new, old: new.end >= old.end and (new.head.startswith(old.head) if old.head else new.path == old.path)
    by_path, found, rest = {old.path: name for name, old in known.items()}, {}, []
    for new in sorted(listed):
        name = by_path.get(new.path)
        if name is not None and continues(new, known[name]):
            found[name] = new
        else:
            rest.append(new)
    for new in rest:
        moved = [n for n, old in known.items() if n not in found and old.head and continues(new, old)]
        name, number = max(moved, key=lambda n: known[n].end) if moved else new.path, 2
        while not moved and (name in found or name in known):
            name, number = f"{new.path}#{number}", number + 1
        found[name] = new
    return found


def test_renamed_files_are_found_as_by_comparing_all():
    pick = random.Random(7)
    for _ in range(300):
        some = lambda: [Seen(p, e, "".join(pick.choice(("aa", "bb")) for _ in range(min(e, 3))), 1) for p in pick.sample("pqrstuvw", pick.randint(0, 8)) for e in [pick.randint(0, 6)]]
        known = {f"{seen.path}#2" if pick.random() < 0.3 else seen.path: seen for seen in some()}
        listed = some()
        assert same_files(known, listed) == continued(known, listed), (known, listed)


def test_many_renamed_files_do_not_meet_in_pairs():
    many = 20_000
    known = {f"a{i}": Seen(f"a{i}", 9, f"{i % (many // 2):08x}", 1) for i in range(many)}
    moved = [old._replace(path=f"b{old.path}", end=12, head=f"{old.head}ff") for old in known.values()]
    started = time.perf_counter()
    found = same_files(known, moved)
    assert time.perf_counter() - started < 10
    assert found.keys() == known.keys() and all(found[n].head == f"{old.head}ff" for n, old in known.items())


def planned(tmp_path, files, **options):
    """A folder of short files, a reader of them and its tasks."""
    live = tmp_path / "live"
    live.mkdir()
    for i in range(files):
        append(live / f"{i}.log", f"line {i}\nmore {i}\n")
    reader = TailReader(f"file://{live}", "*.log*", f"file://{tmp_path}/registry.json", options.get("step", 1 << 20), options.get("tasks", 2))
    end = reader.latestOffset()
    return live, reader, end, reader.partitions({}, end)


def read(reader, tasks):
    return sorted(m for task in tasks for batch in reader.read(task) for m in batch.column("message").to_pylist())


def test_short_files_share_tasks_and_no_task_lists_the_folder(tmp_path, monkeypatch):
    live, reader, end, tasks = planned(tmp_path, 40)
    # Four openings of 256 KB, or three with their bytes, to a task of 1 MB.
    assert len(tasks) == 14
    # Offsets, which are stored with every batch and reported, do not hold the files' first bytes.
    assert len(json.dumps(end)) < 40 * (len(str(live)) + 40)
    monkeypatch.setattr(tail.fs, "FileSelector", lambda *a, **b: pytest.fail("a task lists the folder"))
    assert read(reader, tasks) == sorted(f"{w} {i}" for i in range(40) for w in ("line", "more"))


def test_files_renamed_behind_the_listing_are_read_where_they_are(tmp_path):
    live, reader, end, tasks = planned(tmp_path, 5)
    for i in (1, 3):
        (live / f"{i}.log").rename(live / f"{i}.log.1")
    append(live / "3.log", "another file of that name\n")
    assert read(reader, tasks) == sorted(f"{w} {i}" for i in range(5) for w in ("line", "more"))
    (live / "4.log").unlink()
    with pytest.raises(FileNotFoundError):
        read(reader, tasks)


def test_offsets_of_earlier_versions_go_on(tmp_path):
    live, reader, end, _ = planned(tmp_path, 2)
    before = {name: json.dumps(seen) for name, seen in reader._known().items()}
    append(live / "1.log", "new\n")
    assert read(reader, reader.partitions(before, reader.latestOffset())) == ["new"]
    assert read(reader, reader.partitions({}, before)) == ["line 0", "line 1", "more 0", "more 1"]


def test_a_batch_reads_its_source_once(spark, tmp_path):
    ddl = "message string, service string, log_type string, file string, block bigint, at bigint, arrived date"
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    rows = [(f"{HEAD % i}x", "s", "l", f"f{i % 3}", 0, i, DAY) for i in range(30)]
    batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), ddl)
    logs.tail_writer(str(tmp_path / "records"), str(tmp_path / "open"), DAY)(batch, 0)
    assert spark.read.parquet(str(tmp_path / "records")).count() == 27
    assert read.value == 30
