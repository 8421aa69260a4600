import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup
from tidemark.llm.common import LAST_ID


def brute(rows):
    docs = [(LAST_ID if i is None else i, (t or "").encode(), i) for i, t in rows]
    first = {}
    for d, b, _ in docs:
        for s in range(len(b) - 99):
            window = b[s : s + 100]
            first[window] = min(first.get(window, (d, s)), (d, s))
    out = []
    for d, b, i in docs:
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (d, s):
                gone[s : s + 100] = b"\1" * 100
        runs = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_equals_brute_force(frame, rows, corpus, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "chunked", lambda d, i, t, f=suffix_dedup.chunked: f(d, i, t, size))
    got = rows(suffix_dedup.remove_repeats(frame(corpus, "doc_id long, text string")))
    assert got == brute(corpus)
    assert sum(r[2] for r in got) > 10_000


def test_frequent_anchors_are_dealt_out_by_content(frame, rows, corpus, monkeypatch):
    def some(found, spark):
        hashes = set()
        for r in found.where("kind = 'hit'").collect():
            hashes |= set(suffix_dedup.unpack(r["payload"], *suffix_dedup.HIT)[4].tolist())
        return np.array(sorted(hashes)[::2], np.uint64)

    monkeypatch.setattr(suffix_dedup, "_frequent", some)
    assert rows(suffix_dedup.remove_repeats(frame(corpus, "doc_id long, text string"))) == brute(corpus)


def test_kept_bytes_and_spans(frame):
    text = "x" * 30 + "".join(chr(97 + i % 26) + str(i) for i in range(60))
    out = suffix_dedup.remove_repeats(frame([(1, text), (2, "?" + text)], "doc_id long, text string"), texts=True)
    found = {r["doc_id"]: r for r in out.collect()}
    assert bytes(found[1]["kept"]) == text.encode()
    assert (found[2]["starts"], found[2]["ends"], bytes(found[2]["kept"])) == ([1], [len(text) + 1], b"?")


def test_empty_table(frame):
    assert suffix_dedup.remove_repeats(frame([], "doc_id long, text string")).collect() == []


def test_sorted_groups_equal_a_dictionary():
    source = random.Random(3)
    data = bytes(source.choice(b"ab") for _ in range(3000)) + bytes(range(97, 123)) * 40
    begin = np.arange(len(data) - 60)
    for depth in (5, 16, 33, 60):
        want = {}
        for b in begin.tolist():
            want.setdefault(data[b : b + depth], []).append(b)
        got = [sorted(g) for g in suffix_dedup.equal_prefixes(data, begin, depth)]
        assert got == [want[k] for k in sorted(want) if len(want[k]) > 1]
