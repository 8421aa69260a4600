"""Whitening against plain numpy and against exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import polar_whitening as pw
from tidemark.llm.queries import QUERIES

DDL = "vec_id long, embedding array<double>"


def brute(rows):
    """What the contract says, in fractions: n, sums, covariance and every row's whole vector."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    dims = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in kept if len(v) == dims]
    fit = sorted({x for _, x in whole})
    n = len(fit)
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n) for b in range(dims)] for a in range(dims)])
    return whole, n, sums, cov


def compare(df, rows, most=4):
    whole, n, sums, cov = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    want = {}
    for i, x in whole:
        want.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))), []).append(x)
    assert got.keys() == want.keys()
    signs = np.zeros(len(values))
    for key, xs in want.items():
        assert sorted(got[key]) == list(range(1, len(values) + 1))
        for c, rs in got[key].items():
            assert len(rs) == len(xs) and all(r["n"] == n for r in rs)
            assert rs[0]["explained"] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            assert rs[0]["identity_error"] < 1e-9
            exact = [float(a - Fraction(s, n)) for a, s in zip(xs[0], sums)]
            z = float(np.dot(exact, vectors[:, c - 1])) / math.sqrt(values[c - 1])
            if abs(z) > 1e-6:
                sign = np.sign(z) * np.sign(rs[0]["whitened"])
                assert signs[c - 1] in (0, sign)
                signs[c - 1] = sign
            assert abs(rs[0]["whitened"]) == pytest.approx(abs(z), abs=1e-8)


def some(size=6, count=150):
    source = np.random.default_rng(4)
    mixing = source.normal(size=(size, size))
    return [(i, (source.normal(size=size) @ mixing + 3).tolist()) for i in range(count)]


def test_rows_against_fractions(frame):
    rows = some()
    # A third of the rows are copies of one vector; other rows take no part.
    rows += [(1000 + i, rows[7][1]) for i in range(70)]
    rows += [(2000, None), (2001, []), (2002, [1.0, None] + [1.0] * 4), (2003, [math.nan] * 6), (2004, [math.inf] + [0.0] * 5), (2005, [1.0, 2.0])]
    rows += [(None, rows[3][1]), (None, rows[4][1]), (7, rows[7][1]), (3000, [-0.0] * 6), (3001, [0.001] * 6)]
    compare(pw.whitened(frame(rows, DDL)), rows)


def test_matrix_is_exact_for_huge_entries(frame):
    """Sums far beyond 64 bits; neighbouring values differ in the last digit only."""
    rows = [(i, [2.0**44 + i, -(2.0**43) - (i * i) % 11, float(i % 3)]) for i in range(60)]
    whole, n, sums, cov = brute(rows)
    fit = pw.quantised(frame(rows, DDL)).select("x").distinct()
    got_n, *got_sums = pw.exact_sums(fit, 4, pw._plain, 3)
    assert (got_n, got_sums) == (n, sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    squares = pw.exact_sums(fit, 6, pw._squares(centre), 3)
    assert np.array_equal(pw.covariance(n, [s - n * c for s, c in zip(sums, centre.tolist())], squares), cov)


def test_deviation_beyond_a_long_is_null(frame):
    found = pw.whitened(frame([(1, [1e17, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], DDL)).collect()
    assert len(found) == 6 and all(r["deviation"] is None for r in found if r["vec_id"] == 2)


def test_without_variance(frame):
    same = pw.whitened(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], DDL)).collect()
    assert len(same) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, None, None)}
    line = pw.whitened(frame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], DDL)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and len(line) == 27
    assert {round(r["explained"], 9) for r in line} == {1.0, 0.0}


def test_no_rows(frame):
    for rows in ([], [(1, None), (2, [math.nan])]):
        df = pw.whitened(frame(rows, DDL))
        assert df.collect() == [] and ", ".join(f"{n} {t}" for n, t in df.dtypes).replace("bigint", "long") == pw.SCHEMA


def test_limbs_add_up():
    for total in (0, 1, -1, 2**31, 2**32, -(2**32), 2**63, -(2**95) + 12345, 10**30):
        limbs = list(pw._limbs(0, total))
        assert sum(v << (pw.LIMB * k) for _, k, v in limbs) == total and all(-(2**32) <= v < 2**32 for _, _, v in limbs)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    whole, n, sums, _ = brute([(i, v[:2]) for i, v in rows])
    x = np.array(sorted({tuple(math.floor(256 * c) for c in v) for _, v in rows}), np.float64)
    cov = np.cov(x.T, bias=True)
    values = np.linalg.eigvalsh(cov)[::-1][:4]
    found = QUERIES["op12_polar_whitening"](spark, sf).collect()
    assert len(found) == 4 * len(rows) and found[0]["n"] == len(x)
    for r in found[:8]:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9) and r["identity_error"] < 1e-9
