from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import merge
from tidemark.sinks import files

SCHEMA = "k string, v int, n int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_insert_ignore_never_changes_existing_rows(spark, rows):
    target = frame(spark, ("a", 1, 1))
    source = frame(spark, ("a", 9, 1), ("b", 2, 2), ("b", 3, 1))
    once = merge.insert_ignore(target, source, ["k"], ["n"])
    assert rows(once) == [("a", 1, 1), ("b", 3, 1)]
    assert rows(merge.insert_ignore(once, source, ["k"], ["n"])) == rows(once)
    assert rows(merge.new_rows(target, source, ["k"], ["n"])) == [("b", 3, 1)]


def test_upsert_takes_the_last_row_and_is_idempotent(spark, rows):
    target = frame(spark, ("a", 1, 1), ("c", 5, 5))
    source = frame(spark, ("a", 9, 1), ("a", 8, 2), ("b", 2, 2))
    once = merge.upsert_by_key(target, source, ["k"], ["n"])
    assert rows(once) == [("a", 8, 2), ("b", 2, 2), ("c", 5, 5)]
    assert rows(merge.upsert_by_key(once, source, ["k"], ["n"])) == rows(once)


records = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 3), st.integers(0, 3)), max_size=8)


@settings(max_examples=10, deadline=None)
@given(records, records)
def test_merges_agree_with_a_dictionary(spark, target, source):
    target = list({k: (k, v, n) for k, v, n in target}.values())
    old = {k: (v, n) for k, v, n in target}
    by_order = sorted(source, key=lambda r: (r[0], r[2], r[1]))
    first = {k: (v, n) for k, v, n in reversed(by_order)}
    last = {k: (v, n) for k, v, n in by_order}
    left, right = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    got = {r.k: (r.v, r.n) for r in merge.insert_ignore(left, right, ["k"], ["n"]).collect()}
    assert got == {**first, **old}
    got = {r.k: (r.v, r.n) for r in merge.upsert_by_key(left, right, ["k"], ["n"]).collect()}
    assert got == {**old, **last}


def test_empty_sides(spark, rows):
    some, none = frame(spark, ("a", 1, 1)), frame(spark)
    assert rows(merge.insert_ignore(none, some, ["k"])) == rows(merge.upsert_by_key(some, none, ["k"])) == [("a", 1, 1)]


def test_keys_only(spark, rows):
    target = spark.createDataFrame([("a",)], "k string")
    source = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert rows(merge.insert_ignore(target, source, ["k"])) == [("a",), ("b",)]


def test_hot_repeated_key_is_reduced_before_the_shuffle(spark, plan):
    text = plan(merge.new_rows(frame(spark), frame(spark, ("a", 1, 1)), ["k"]))
    assert "partial_min" in text and "Window" not in text


def test_merge_statement():
    text = merge.merge_statement("t1", "s1", ["k", "j"])
    assert "ON t.`k` <=> s.`k` AND t.`j` <=> s.`j`" in text and "UPDATE SET *" in text
    assert "UPDATE" not in merge.merge_statement("t1", "s1", ["k"], update=False)


def test_only_touched_partitions_are_rebuilt(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 1, 2)], "k string, v int, d int")
    files.write_partitioned(base, path, ["d"])
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=1").iterdir()}
    source = spark.createDataFrame([("b", 7, 2), ("x", 8, 3)], "k string, v int, d int")
    for _ in range(2):
        files.upsert_partitions(spark, path, source, ["d", "k"], by="d")
    assert rows(spark.read.parquet(path), "k", "v", "d") == [("a", 1, 1), ("b", 7, 2), ("c", 1, 2), ("x", 8, 3)]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=1").iterdir()} == untouched
    for _ in range(2):
        files.append_new(spark, path, source.selectExpr("k", "v + 1 AS v", "d + 1 AS d"), ["d", "k"], by="d")
    assert rows(spark.read.parquet(path).where("d > 2"), "k", "v", "d") == [("b", 8, 3), ("x", 8, 3), ("x", 9, 4)]


def test_keys_with_nulls_are_keys(spark, rows):
    target, source = frame(spark, (None, 1, 1), ("a", 1, 1)), frame(spark, (None, 2, 2), ("b", 1, 1))
    once = merge.upsert_by_key(target, source, ["k"], ["n"])
    assert rows(once) == rows(merge.upsert_by_key(once, source, ["k"], ["n"])) == sorted([(None, 2, 2), ("a", 1, 1), ("b", 1, 1)], key=repr)
    assert rows(merge.insert_ignore(target, source, ["k"], ["n"])) == sorted([(None, 1, 1), ("a", 1, 1), ("b", 1, 1)], key=repr)
