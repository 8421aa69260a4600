import zlib

import numpy as np

from tidemark.llm import fourier_quality


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = fourier_quality.quality_scores(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r["doc_id"]: r["score"] for r in fourier_quality.quality_scores(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_edge_rows(frame, spark, corpus):
    docs = frame(corpus, "doc_id long, text string")
    labels = frame([(i, i % 2) for i in range(40)] + [(1, None), (None, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    found = fourier_quality.quality_scores(docs, labels).collect()
    assert len(found) == len(corpus) and all(0 <= r["score"] <= 1 for r in found)
    by_key = {}
    for r in found:
        by_key.setdefault(r["text_key"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_key.values())
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)


def test_no_labels_or_one_kind(frame, corpus):
    docs = frame(corpus, "doc_id long, text string")
    scores = {r["score"] for r in fourier_quality.quality_scores(docs, frame([], "doc_id long, quality int")).collect()}
    assert scores == {0.5}
    one = frame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert min(r["score"] for r in fourier_quality.quality_scores(docs, one).collect()) > 0.5
    assert fourier_quality.quality_scores(frame([], "doc_id long, text string"), one).collect() == []


def test_isotonic_fit_is_monotone_and_keeps_the_mean():
    source = np.random.default_rng(5)
    x = np.sort(source.random(200))
    n = source.integers(1, 9, 200).astype(float)
    good = np.array([source.binomial(int(k), p) for k, p in zip(n, x, strict=True)], float)
    places, values = fourier_quality.isotonic(x, good, n)
    assert (np.diff(values) >= 0).all() and (np.diff(places) > 0).all()
    # The max-min formula of the best non-decreasing fit.
    mean = lambda a, b: good[a : b + 1].sum() / n[a : b + 1].sum()
    best = [max(min(mean(a, b) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    pooled = fourier_quality.isotonic(x[:60], good[:60], n[:60])[1]
    assert np.allclose(sorted(set(np.round(best, 9))), sorted(set(np.round(pooled, 9))))


def test_cosines_approximate_the_kernel():
    source = np.random.default_rng(6)
    dims = 5
    x = source.normal(size=(6, dims))
    projection = source.normal(size=(dims, 20_000)) / np.sqrt(dims)
    phi = fourier_quality.cosines(x, 0, 1, projection, source.uniform(0, 2 * np.pi, 20_000))[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(phi @ phi.T - np.exp(-apart / (2 * dims))).max() < 0.05
