"""Ranked search against scoring every document, and the block bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import geometric_search as gs

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, n=10):
    """(item, rank) with score and doc_id; rows of equal id and score can change places."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total, n_docs = sum(size for *_, size in counts), len(counts)
    df = Counter(t for _, c, _ in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    found = set()
    for item, own in wanted.items():
        scores = []
        for i, c, size in counts:
            m = 100 - 90 + (90 * size * n_docs) // total
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        found |= {(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:n], 1)}
    return found


def answer(df):
    rows = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.fixture
def texts():
    """Common and rare terms, some of several bytes, copies, ties, one hot document shape, very long and empty texts."""
    source = random.Random(8)
    words = [f"w{i}" for i in range(300)] + ["Übung", "ÜBUNG", "a_b", "x-y", "İ", "日本語", "naïve", "A1"]
    share = [1 / (i + 1) for i in range(len(words))]
    make = lambda k: " ".join(source.choices(words, share, k=k))
    docs = [(i, make(source.randint(0, 60))) for i in range(600)]
    docs += [(1000 + i, docs[5][1]) for i in range(200)] + [(2000, make(30_000)), (2001, None), (2002, ""), (2003, "?!"), (None, docs[7][1]), (3, docs[9][1])]
    docs += [(3000 + i, "hot") for i in range(150)]
    items = [(i, make(source.randint(1, 40))) for i in range(40)]
    items += [(100, None), (101, "-"), (102, "nowhere"), (103, "hot hot HOT"), (None, "w1 w200"), (None, "w250"), (7, "w299 Übung"), (104, docs[5][1])]
    source.shuffle(docs)
    return docs, items


def test_equals_scoring_every_document(frame, texts):
    docs, items = texts
    assert answer(gs.ranked(frame(docs, DOCS), frame(items, ITEMS))) == brute(docs, items)


def test_many_shards_blocks_and_rounds(frame, texts, monkeypatch):
    docs, items = texts
    for name, value in {"SHARD_DOCUMENTS": 40, "BLOCK_TERMS": 50, "ROUND_TERMS": 200, "FIRST": 2, "BLOCK": 4, "STEP": 500}.items():
        monkeypatch.setattr(gs, name, value)
    assert answer(gs.ranked(frame(docs, DOCS), frame(items, ITEMS), n=3)) == brute(docs, items, 3)


def some_index(docs, items):
    """An index of one shard over plain lists, made without Spark."""
    vocabulary = sorted({t for _, t in items for t in terms(t)})
    number = {t: i for i, t in enumerate(vocabulary)}
    counts = [Counter(terms(t)) for _, t in docs]
    rows = [sorted((number[t], k) for t, k in c.items() if t in number) for c in counts]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = [x for r in rows for x in r]
    shard = gs.Shard(np.arange(len(docs)), np.ones(len(docs), bool), np.array([sum(c.values()) for c in counts]), starts,
        np.array([t for t, _ in flat], np.uint32), np.array([k for _, k in flat]))
    numbers = np.array([i for i, (_, t) in enumerate(items) for _ in set(terms(t))])
    queries, = gs.in_blocks(numbers, np.array([number[x] for _, t in items for x in sorted(set(terms(t)))]))
    df = np.bincount(shard.terms, minlength=len(vocabulary))
    return gs.Index(shard, queries, gs.weights(df, len(docs)), len(docs), int(shard.lengths.sum())), shard, queries


def test_summaries_bound_their_blocks_and_blocks_are_skipped(texts):
    docs, items = [d for d in texts[0] if terms(d[1])], [i for i in texts[1] if terms(i[1])]
    index, shard, queries = some_index(docs, items)
    skipped = entered = 0
    for q in range(len(queries.numbers)):
        own = queries.columns[queries.starts[q] : queries.starts[q + 1]]
        for term in own.tolist():
            rows, starts, summaries, columns = index.blocks(term)
            assert sorted(rows) == np.flatnonzero(index.impacts[:, term] > 0).tolist() or index.most[term] == 0
            for b, summary in enumerate(summaries):
                held = index.impacts[np.ix_(rows[starts[b] : starts[b + 1]], columns)]
                assert len(held) <= gs.BLOCK and (summary == held.max(axis=0)).all()
        found, left, seen = gs.search(index, shard, own, 0, 10)
        scores = index.impacts[:, own].sum(axis=1)
        assert [s for s, _ in sorted(found, reverse=True)] == sorted(scores[scores > 0].tolist(), reverse=True)[:10]
        skipped, entered = skipped + left, entered + seen
    assert skipped > entered / 2


def test_blocks_hold_similar_documents():
    """Documents of two kinds share a term: no block of its list mixes them."""
    kind = lambda i: "l" if i // 3 % 2 else "r"
    docs = [(i, "both " + " ".join(f"{kind(i)}{j}" for j in range(i % 5, i % 5 + 8))) for i in range(400)]
    items = [(0, "both " + " ".join(f"l{j} r{j}" for j in range(13)))]
    index, _, queries = some_index(docs, items)
    term = max(range(len(queries.vocabulary)), key=lambda t: (index.impacts[:, t] > 0).sum())
    rows, starts, *_ = index.blocks(term)
    assert len(rows) == 400 and all(len({kind(r) for r in rows[a:b].tolist()}) == 1 for a, b in zip(starts[:-1], starts[1:]))


def test_empty_tables(frame):
    docs, items = frame([(1, "a b")], DOCS), frame([(1, "a")], ITEMS)
    for df in (gs.ranked(frame([], DOCS), items), gs.ranked(docs, frame([], ITEMS)), gs.ranked(frame([(1, None)], DOCS), items)):
        assert df.collect() == [] and df.columns == ["item_id", "rank", "doc_id", "score"]
