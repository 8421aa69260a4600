import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import block_anchors
from tidemark.llm.common import LAST_ID
from tidemark.llm.words import LOWER, STEP, word_hashes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    docs = [(LAST_ID if i is None else i, WORD.findall((t or "").encode()), i) for i, t in rows]
    least = {}
    for d, words, _ in docs:
        for s in range(len(words) - 49):
            window = tuple(words[s : s + 50])
            least[window] = min(least.get(window, d), d)
    out = []
    for d, words, i in docs:
        gone = [0] * len(words)
        for s in range(len(words) - 49):
            if least[tuple(words[s : s + 50])] < d:
                gone[s : s + 50] = [1] * 50
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_equals_brute_force(frame, rows, corpus, monkeypatch, size):
    monkeypatch.setattr(block_anchors, "chunked", lambda d, i, t, keep, f=block_anchors.chunked: f(d, i, t, size, keep))
    got = rows(block_anchors.remove_repeats(frame(corpus, "doc_id long, text string")))
    assert got == brute(corpus)
    assert sum(r[2] for r in got) > 5_000


def test_texts_and_spans(frame):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "a b  c\n" + " ".join(words) + " d")]
    found = {r["doc_id"]: r for r in block_anchors.remove_repeats(frame(rows, "doc_id long, text string"), texts=True).collect()}
    assert found[1]["kept"] == rows[0][1]
    assert (found[2]["starts"], found[2]["ends"], found[2]["kept"]) == ([3], [63], "a b c d")


def test_empty_table(frame):
    assert block_anchors.remove_repeats(frame([], "doc_id long, text string")).collect() == []


def test_text_is_shuffled_once(frame, corpus):
    df = block_anchors.remove_repeats(frame(corpus, "doc_id long, text string"))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().toString()


def test_long_texts_hash_like_short_ones():
    source = random.Random(1)
    text = " ".join(f"w{source.randint(0, 999)}" + "é" * source.randint(0, 2) for _ in range(300_000)).encode()
    text += b"\n" + b"z" * (3 * STEP) + b" end"
    data = np.frombuffer(text, np.uint8)
    hashes, offsets = word_hashes(data, np.array([0, len(data)]))
    words = text.split()
    seen = {}
    assert len(hashes) == len(words) == offsets[1]
    assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


def test_documents_end_words():
    texts = [b"ab", b"", b"c d", b" ", b"AB"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes, words = word_hashes(LOWER[np.frombuffer(b"".join(texts), np.uint8)], offsets)
    assert words.tolist() == [0, 1, 1, 3, 3, 4] and hashes[0] == hashes[3]


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_documents_keep_their_columns(frame, corpus, monkeypatch, size):
    monkeypatch.setattr(block_anchors, "chunked", lambda d, i, t, keep, f=block_anchors.chunked: f(d, i, t, size, keep))
    docs = frame([(i, t, [k, None], {"k": k}) for k, (i, t) in enumerate(corpus)], "doc_id long, text string, tags array<int>, m map<string, int>")
    cut = block_anchors.cut_documents(docs)
    assert cut.dtypes == [*docs.dtypes, ("words_removed", "bigint")]
    given = {r["m"]["k"]: r for r in docs.collect()}
    want = sorted((r[0], r[1], r[2], r[3]) for r in ((repr(x[0]), *x[1:]) for x in brute(corpus)))
    got = []
    for r in cut.collect():
        before = given[r["m"]["k"]]
        if not r["words_removed"]:
            assert r["text"] == before["text"]
        assert [r[c] for c in docs.columns if c != "text"] == [before[c] for c in docs.columns if c != "text"]
        words = len(WORD.findall((before["text"] or "").encode()))
        kept = b" ".join(WORD.findall((r["text"] or "").encode()))
        got.append((repr(r["doc_id"]), words, r["words_removed"], hashlib.sha256(kept).hexdigest()))
    assert sorted(got) == want and any(r[2] for r in want)


def test_no_documents_with_columns(frame):
    docs = frame([], "doc_id long, text string")
    assert block_anchors.cut_documents(docs).collect() == []


@pytest.mark.parametrize("size", [8 << 20, 600])
def test_negative_ids(frame, rows, prose, monkeypatch, size):
    monkeypatch.setattr(block_anchors, "chunked", lambda d, i, t, keep, f=block_anchors.chunked: f(d, i, t, size, keep))
    line = prose(60)
    data = [(-5, line), (-7, f"{prose(11)} {line}"), (3, f"{prose(7)} {line} {prose(9)}"), (-(2**63), line[:400]), (-(2**63) + 1, prose(80)), (4, prose(30))]
    data += [(9, f"x {data[4][1]}"), (10, f"{prose(13)} {data[0][1]}")]
    got = rows(block_anchors.remove_repeats(frame(data, "doc_id long, text string")))
    assert got == brute(data)
    assert sum(r[2] for r in got) > 200
