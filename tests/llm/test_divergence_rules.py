"""Quality rules against plain Python."""

import math
import re
from collections import Counter

from tidemark.llm import divergence_rules as dr

DDL = "doc_id long, text string, lang string"
BREAK = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = BREAK.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if BREAK.search(line)]
    n, repeated = len(words), len(covered)
    failed = n < 10 or 100 * repeated > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated, failed


def of_class(c):
    groups = ["abcdefghijklmnopqrstuvwxyz", " \t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!\"'(),-.:;?", "\n\x0b\x0c\r", "0123456789", "#$%&*+/<=>@[\\]^_`{|}~"]
    return next((i for i, g in enumerate(groups) if c in g), 7)


def terms(text):
    return [t for t in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if t]


def distance(p, q):
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def brute(rows):
    """Per row the base counts and both distances."""
    out = [[i, *base(t), None, None] for i, t, _ in rows]
    for lang in {g for *_, g in rows}:
        own = [k for k, r in enumerate(rows) if r[2] == lang]
        held = Counter(t for k in own for t in set(terms(rows[k][1])) if len(t) <= dr.LONGEST)
        common = sorted(sorted(held, key=lambda t: (-held[t], t))[: dr.COMMON])
        classes = {k: [sum(of_class(c) == i for c in rows[k][1] or "") for i in range(8)] for k in own}
        words = {k: [terms(rows[k][1]).count(t) for t in common] for k in own}
        words = {k: [*w, len(terms(rows[k][1])) - sum(w)] for k, w in words.items()}
        for place, histogram, least in ((7, classes, dr.LEAST_CHARS), (8, words, dr.LEAST_TERMS)):
            behind = [h for k, h in histogram.items() if sum(h) >= least and not out[k][6]]
            if len(behind) >= dr.LEAST_DOCUMENTS:
                mean = [sum(math.floor(h[i] * 1_000_000 / sum(h)) for h in behind) for i in range(len(behind[0]))]
                for k, h in histogram.items():
                    if sum(h) >= least:
                        out[k][place] = distance(h, mean)
    return out


def texts(prose):
    rows = [(i, prose(20 + 7 * (i % 30)), "en") for i in range(60)] + [(100 + i, "le " + prose(60).upper(), "fr") for i in range(25)]
    rows += [(200 + i, prose(80), None) for i in range(22)] + [(300 + i, prose(80), "rare") for i in range(3)]
    rows += [(400, "#" * 300 + " ".join(f"x{i}" for i in range(60)), "en"), (401, " ".join(f"q{i}z" for i in range(90)), "en"), (402, "a b c d e " * 9, "en")]
    rows += [(403, "one two three four five six one two three four five " + prose(40), "en"), (404, "x " * 9, "fr"), (405, "same\nsame \nsame\n\n \nother\r\n", "fr")]
    rows += [(406, None, None), (407, "", "en"), (408, "\t\x0b\n ", "en"), (None, prose(90), "en"), (None, prose(90), "en"), (5, prose(50), "en"), (409, prose(20_000), "en")]
    rows += [(410, "日本語 " * 70 + "é" * 150, "en"), (411, "é" * 300, "fr"), (412, "a a a a a a " + prose(90), "en")]
    return rows + [(500 + i, rows[3][1], "en") for i in range(40)]


def test_rows_against_plain_python(frame, prose):
    rows = texts(prose)
    got = sorted((tuple(r) for r in dr.quality_verdicts(frame(rows, DDL)).collect()), key=repr)
    want = sorted((tuple(r) for r in brute(rows)), key=repr)
    assert len(got) == len(want)
    rejected = set()
    for g, w in zip(got, want):
        assert g[:7] == tuple(w[:7])
        for a, b in zip(g[7:9], w[7:9]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
        far = (w[7] or 0) > dr.MOST_CLASS_DISTANCE or (w[8] or 0) > dr.MOST_WORD_DISTANCE
        assert g[9] == (not w[6] and not far)
        rejected |= {g[0]} if far and not w[6] else set()
    assert {400, 401} <= rejected and 3 not in rejected


def test_short_and_unknown_languages_are_not_judged(frame, prose):
    rows = texts(prose)
    found = {r["doc_id"]: r for r in dr.quality_verdicts(frame(rows, DDL)).collect()}
    assert found[300]["class_distance"] is None and found[300]["kept"]
    assert found[405]["word_distance"] is None and not found[405]["kept"] and found[405]["base_failed"]


def test_repeated_windows(frame):
    rows = [(1, "a b c d e", "x"), (2, "a b c d e a b c d e", "x"), (3, "a a a a a a", "x"), (4, "a b c d e f a b c d e", "x"), (5, "a b c d a b c d", "x")]
    got = {r["doc_id"]: r["n_repeat_words"] for r in dr.quality_verdicts(frame(rows, DDL)).collect()}
    assert got == {1: 0, 2: 10, 3: 6, 4: 10, 5: 0}


def test_empty_table(frame):
    df = dr.quality_verdicts(frame([], DDL))
    assert df.collect() == [] and df.columns[0] == "doc_id" and df.columns[-1] == "kept"


def test_plan_is_native_and_shuffles_no_document(frame, prose, plan):
    text = plan(dr.quality_verdicts(frame(texts(prose), DDL)))
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange hashpartitioning") == 0
