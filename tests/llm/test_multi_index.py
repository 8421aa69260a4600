import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import multi_index

DDL = "vec_id long, embedding array<double>"


def brute(rows, k):
    size = 8
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, set()).add(tuple(x + 0.0 for x in v))
    out = {}
    for q in (i for i in good if i % 20 == 0):
        scores = [(-max(float(np.dot(a, b)) for a in good[q] for b in good[i]), i) for i in good if i != q]
        out[q] = sorted(scores)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    return out


def test_whole_table_within_the_widest_radius(frame, monkeypatch):
    source = np.random.default_rng(1)
    rows = [(i, source.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(1100 + i, rows[40][1]) for i in range(5)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [math.nan] * 8), (2060, [math.inf] + [1.0] * 7), (2080, [1.0, None] + [1.0] * 6)]
    rows += [(2100, [1.0, 2.0]), (2120, []), (None, [1.0] * 8), (60, rows[60][1]), (2140, [-0.0, 1.0] + [0.0] * 6)]
    # A radius that holds every code makes the search exact.
    monkeypatch.setattr(multi_index, "RECALL", 1.0)
    real = multi_index.fit
    monkeypatch.setattr(multi_index, "fit", lambda s, k: real(s, k)._replace(radius=256))
    monkeypatch.setattr(multi_index, "SHARD", 90)
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 7)
    got = found(multi_index.nearest(frame(rows, DDL), F.col("vec_id") % 20 == 0))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=0, atol=1e-12)


def test_recall_of_learned_codes(frame):
    source = np.random.default_rng(2)
    centres = source.normal(size=(10, 8))
    rows = [(i, (centres[i % 10] + source.normal(size=8)).tolist()) for i in range(2000)]
    got, want = found(multi_index.nearest(frame(rows, DDL), F.col("vec_id") % 20 == 0)), brute(rows, 20)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and all(len(v) == 20 for v in got.values())


def test_pigeonhole_finds_every_code_in_the_radius():
    source = np.random.default_rng(3)
    codes = source.integers(0, 2**16, (500, 4), dtype=np.uint16)
    codes[100:200] = codes[0] ^ (source.random((100, 4)) < 0.5) * (1 << source.integers(0, 16, (100, 4))).astype(np.uint16)
    index = multi_index.Index(codes)
    for radius in (0, 1, 2, 3, 5, 10, 25, 64):
        apart = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_few_rows(frame):
    rows = [(0, [1.0] * 8), (1, [2.0] * 8), (20, [0.5] * 8)]
    got = found(multi_index.nearest(frame(rows, DDL), F.col("vec_id") % 20 == 0))
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [1, 20], 20: [1, 0]}
    assert multi_index.nearest(frame([(0, [1.0] * 8)], DDL), F.col("vec_id") % 20 == 0).collect() == []
    assert multi_index.nearest(frame([(1, [1.0] * 8), (2, [1.0] * 8)], DDL), F.col("vec_id") % 20 == 0).collect() == []


def test_empty_table(frame):
    df = multi_index.nearest(frame([], DDL), F.col("vec_id") % 20 == 0)
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.collect() == []
    assert multi_index.nearest(frame([(1, None), (20, [0.0])], DDL), F.col("vec_id") % 20 == 0).collect() == []
