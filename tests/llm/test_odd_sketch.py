import random
import re
from itertools import combinations

import numpy as np

from tidemark.llm import odd_sketch
from tidemark.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute(rows):
    """Smallest reachable id by row; rows without an id are nodes by their text."""
    node = [(0, i) if i is not None else (1, t or "") for i, t in rows]
    sets = [shingles(t) for _, t in rows]
    parent = {n: n for n in node}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(node[a]), find(node[b])))
            parent[y] = x
    roots = [find(n) for n in node]
    return sorted(
        ((i, len(s), r[1] if r[0] == 0 else None, n == r) for (i, _), s, n, r in zip(rows, sets, node, roots, strict=True)), key=repr
    )


def test_equals_brute_force(frame, rows, corpus, prose):
    source = random.Random(9)
    data = list(corpus)
    # A chain: neighbours are near, the ends are far apart.
    words = prose(120).split()
    for i in range(12):
        data.append((500 + i, " ".join(words)))
        words = words[6:] + prose(6).split()
    # Edits around the threshold.
    base = prose(100).split()
    for i in range(30):
        changed = list(base)
        for place in source.sample(range(len(base)), source.randint(1, 8)):
            changed[place] = f"new{i}x{place}"
        data.append((600 + i, " ".join(changed)))
    data += [(700, "one two"), (701, "ONE  two"), (702, "one two three"), (703, "a b c d e"), (704, "a b c d")]
    got = rows(odd_sketch.near_duplicates(frame(data, "doc_id long, text string")).drop("text_key"))
    want = brute(data)
    assert got == want
    assert len({r[2] for r in want}) < len(want) - 50


def edited(prose, count, seed):
    """Copies of a text that is not among them: edits of their own, edits in common, few and many."""
    source = random.Random(seed)
    base = prose(100).split()
    variants = [source.sample(range(100), 9) for _ in range(12)]
    made = []
    for i in range(count):
        changed = list(base)
        for place in source.sample(range(100), source.choice((1, 2, 3, 3, 5, 7))):
            changed[place] = f"own{i}x{place}"
        if i % 4 == 0:
            for place in variants[i // 4 % 12][: source.randint(4, 9)]:
                changed[place] = f"common{i // 4 % 12}x{place}"
        made.append((i, " ".join(changed)))
    return made


def test_full_buckets_equal_brute_force(frame, rows, prose, monkeypatch):
    """Links that only edits in common make are found in groups that are not compared pair by pair."""
    monkeypatch.setattr(odd_sketch, "SMALL", 8)
    data = edited(prose, 500, 3) + [(10_000 + i, t) for i, t in edited(prose, 150, 4)]
    data += [(None, data[40][1]), (3, data[44][1]), (3, data[45][1])]
    got, want = rows(odd_sketch.near_duplicates(frame(data, "doc_id long, text string")).drop("text_key")), brute(data)
    assert got == want and 3 < len({r[2] for r in want}) < 600


def test_full_buckets_are_not_squared(frame, prose, monkeypatch):
    """Far fewer pairs than members outside the largest component times all members; those with edits in common are left."""
    sizes = {}

    def counted(df, label):
        sizes[label] = sizes.get(label, 0) + df.count()
        return real(df, label)

    real = odd_sketch.staged
    monkeypatch.setattr(odd_sketch, "staged", counted)
    odd_sketch.near_duplicates(frame(edited(prose, 1_000, 5), "doc_id long, text string")).collect()
    assert sizes["members"] > 900 and sizes["sharing"] < 15_000


def test_no_documents(frame):
    assert odd_sketch.near_duplicates(frame([], "doc_id long, text string")).collect() == []


def test_sketches_estimate_similarity():
    source = np.random.default_rng(4)
    a = source.integers(0, 2**64, 4000, dtype=np.uint64)
    for share, low, high in ((1.0, 1.0, 1.0), (0.9, 0.8, 0.97), (0.5, 0.35, 0.65)):
        n = int(len(a) * 2 * share / (1 + share))
        b = np.concatenate([a[:n], source.integers(0, 2**64, len(a) - n, dtype=np.uint64)])
        x, y = (odd_sketch.sketch(odd_sketch.samples(np.sort(s))) for s in (a, b))
        bits = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        estimate = 1 + odd_sketch.SKETCH_BITS / (4 * odd_sketch.SAMPLES) * np.log(1 - 2 * bits / odd_sketch.SKETCH_BITS)
        assert low <= estimate <= high
        assert (bits <= odd_sketch.MOST_BITS) or share < 0.6


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["doc_id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}
