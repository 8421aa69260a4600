import hashlib

import numpy as np
import pytest

from tidemark.llm import perfect_hash


def brute(rows):
    lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()) for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, lower, strict=True):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, lower, strict=True):
        keep = max((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_rows", [50_000, 7])
def test_equals_brute_force(frame, rows, corpus, monkeypatch, shard_rows):
    monkeypatch.setattr(perfect_hash, "SHARD_ROWS", shard_rows)
    data = [*corpus, (800, "É same"), (801, "é same"), (2**62, corpus[0][1]), (-5, corpus[0][1])]
    history, incoming = perfect_hash.split_at_median(frame(data, "doc_id long, text string"))
    assert history.count() and incoming.count()
    assert rows(perfect_hash.exact_dedup(history, incoming).drop("historical")) == brute(data)


@pytest.mark.parametrize("empty", ["history", "incoming", "both"])
def test_empty_sides(frame, rows, corpus, empty):
    none, some = frame([], "doc_id long, text string"), frame(corpus, "doc_id long, text string")
    history, incoming = {"history": (none, some), "incoming": (some, none), "both": (none, none)}[empty]
    got = rows(perfect_hash.exact_dedup(history, incoming).drop("historical"))
    assert got == ([] if empty == "both" else brute(corpus))


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**64, 20_000, dtype=np.uint64))
    hashed = perfect_hash.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    others = hashed.slots(keys + np.uint64(1))
    assert (others < len(keys)).all()
