import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import mixture_packing
from tidemark.llm.mixture_packing import Mixture, node_places

PATH = public_tokenizers.path("word_bpe_49k.json")
DDL = "doc_id long, source string, text string"


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_every_token_has_one_seat():
    source = random.Random(3)
    for _ in range(60):
        totals = [source.choice([0, 1, 3, source.randint(1, 200), source.randint(1, 5000)]) for _ in range(source.randint(1, 9))]
        length = source.choice([8, 16, 64])
        mixture = Mixture(totals, length, block=source.choice([1, 3, 8]))
        seats = {}
        for queue, total in enumerate(totals):
            at = 0
            while at < total:
                n = min(total - at, source.randint(1, 90))
                done = 0
                for start, size, sequence, offset in mixture.pieces(queue, at, n):
                    assert start == done and size > 0
                    done += size
                    seats.setdefault(sequence, []).append((offset, size, queue))
                assert done == n
                at += n
        assert sorted(seats) == list(range(len(seats)))
        for sequence, pieces in seats.items():
            end = 0
            for offset, size, _ in sorted(pieces):
                assert offset == end
                end += size
            full = sequence < sum(totals) // length
            assert end == length if full else end < length and end & (end - 1) == 0
            for queue, total in enumerate(totals):
                own = sum(size for _, size, q in pieces if q == queue)
                assert not full or abs(own - length * total / sum(totals)) < 2 + len(totals)


def test_blocks_carry_what_queues_are_owed():
    totals = [70_000, 20_001, 9_333, 700, 1]
    for block in (1, 7, 1000):
        mixture = Mixture(totals, 64, block)
        for b in range(mixture.blocks):
            starts, _ = mixture.served(b)
            ideal = np.outer((b * block + np.arange(len(starts))) * 64, totals) / sum(totals)
            assert np.abs(starts - ideal).max() < len(totals)


def check(found, data, ids_of, length):
    """Pieces of all documents against the ids of each; equal texts are told apart by counting."""
    want = sorted(((i, ids_of(t)) for i, _, t in data), key=repr)
    cut = {}
    for p in found:
        part = np.array(p["ids"], "<u4")
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"] and len(part) == p["length"]
        cut.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    got = []
    for (doc, n), pieces in cut.items():
        by_start = {}
        for p in pieces:
            by_start.setdefault(p["start"], []).append(p)
        while by_start:
            ids = []
            while len(ids) < n:
                p = by_start[len(ids)].pop()
                if not by_start[len(ids)]:
                    del by_start[len(ids)]
                ids += p["ids"]
            got.append((doc, ids))
    assert sorted(got, key=repr) == want
    ends = {}
    for p in sorted(found, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0)
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(e == length or e & (e - 1) == 0 for e in ends.values())


def test_packs_every_id_once(frame, prose, ids_of, monkeypatch):
    monkeypatch.setattr(mixture_packing, "ROW_BYTES", 2000)
    source = random.Random(2)
    data = [(i, source.choice(["a", "a", "b", "c", None]), prose(source.randint(0, 80))) for i in range(60)]
    data += [(60, "a", None), (61, "d", ""), (None, "b", prose(10)), (62, "b", prose(3_000)), (63, "a", "É İ ǰ J̌ Σς <|endoftext|>")]
    for length in (64, 4096):
        found = mixture_packing.pack(frame(data, DDL), PATH, 2, length=length, with_ids=True).collect()
        check(found, data, ids_of, length)


def test_many_sources_share_the_last_queue(frame, prose, ids_of, monkeypatch):
    monkeypatch.setattr(mixture_packing, "QUEUES", 3)
    data = [(i, f"s{i % 9}", prose(20 + i % 9)) for i in range(40)]
    check(mixture_packing.pack(frame(data, DDL), PATH, 2, length=64, with_ids=True).collect(), data, ids_of, 64)


def test_repeated_rows_are_packed_each(frame, prose):
    data = [(1, "a", prose(30))] * 3
    found = mixture_packing.pack(frame(data, DDL), PATH, 2, length=64).collect()
    assert sum(p["length"] for p in found) == 3 * found[0]["doc_tokens"]


def test_empty_table(frame):
    assert mixture_packing.pack(frame([], DDL), PATH, 2).collect() == []


def test_words_coded_alone_equal_whole_texts(ids_of):
    coder = mixture_packing.WordCoder(open(PATH, encoding="utf-8").read())
    source = random.Random(4)
    texts = ["".join(source.choice(" \n\tabTHEst12!'é́̌JjIİΣς日 ") for _ in range(source.randint(0, 80))) for _ in range(2000)]
    for text, packed in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(packed, coder.kind).tolist() == ids_of(text)[:-1]


def test_places_in_a_node_follow_virtual_finishing_times():
    source = random.Random(7)
    for _ in range(60):
        totals = np.array([source.randint(1, 60) for _ in range(source.randint(1, 6))])
        turn = source.choice([1, 2, 5])
        turns = -(-totals // turn)
        order = sorted((Fraction(2 * q + 1, int(turns[c])), c, q) for c in range(len(totals)) for q in range(turns[c]))
        want, at = {}, 0
        for _, c, q in order:
            for i in range(q * turn, min((q + 1) * turn, totals[c])):
                want[c, i], at = at, at + 1
        for c, total in enumerate(totals):
            a = source.randrange(total)
            places, sizes = node_places(totals, turn, c, np.array([0, a]), np.array([total, total - a]))
            found = [p + k for p, n in zip(places, sizes, strict=True) for k in range(n)]
            assert found == [want[c, i] for i in [*range(total), *range(a, total)]]
    big = np.array([10**13, 3 * 10**12, 1])
    places, sizes = node_places(big, 16, 1, np.array([10**12]), np.array([16]))
    assert sizes.sum() == 16 and abs(places[0] - (10**12 * 13 // 3)) < 64


@pytest.mark.parametrize("fan", [2, 3, 32])
def test_sources_without_a_queue_keep_their_proportion(frame, ids_of, monkeypatch, fan):
    monkeypatch.setattr(mixture_packing, "QUEUES", 4)
    monkeypatch.setattr(mixture_packing, "FAN", fan, raising=False)
    monkeypatch.setattr(mixture_packing, "ROW_BYTES", 3000)
    # Sources one after the other in the table, as files of a source each are.
    data = [(i, f"s{i // 40}" if i // 40 else None, "a b c d e " * (3 + i // 40 % 4)) for i in range(480)]
    length = 256
    found = mixture_packing.pack(frame(data, DDL).orderBy("doc_id"), PATH, 2, length=length, with_ids=True).collect()
    check(found, data, ids_of, length)
    total = sum(p["length"] for p in found)
    held, in_window = {}, {}
    for p in found:
        s = p["doc_id"] // 40
        held[s] = held.get(s, 0) + p["length"]
        in_window[s, p["sequence_id"]] = in_window.get((s, p["sequence_id"]), 0) + p["length"]
    for s, n in held.items():
        mean = length / len(held)
        for w in range(total // length):
            so_far = sum(in_window.get((s, v), 0) for v in range(w + 1))
            assert abs(so_far - (w + 1) * length * n / total) < 3 * mean
            assert in_window.get((s, w), 0) > 0


def test_added_tokens_are_coded_as_the_tokenizer_does():
    tokenizer = Tokenizer.from_file(PATH)
    coder = mixture_packing.WordCoder(open(PATH, encoding="utf-8").read(), added_tokens=True)
    source = random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "<|endof", "A", "É", "́", "ǰ", " ", "\n", "word", "`"]
    texts = ["".join(source.choice(parts) for _ in range(source.randint(0, 12))) for _ in range(2000)]
    for text, packed in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(packed, coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_query_codes_added_tokens(spark, tmp_path):
    from tidemark.llm.queries import op2_mixture_packing

    texts = {1: "a <|endoftext|> b", 2: "<|startoftext|>A", 3: "plain text", 4: "<|ENDOFTEXT|>"}
    spark.createDataFrame([(i, "s", t) for i, t in texts.items()], DDL).write.parquet(str(tmp_path / "documents.parquet"))
    found = op2_mixture_packing(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert {p["doc_id"]: p["doc_tokens"] for p in found} == want


def test_plain_words_are_coded_without_marks_as_the_tokenizer_does():
    with open(PATH, encoding="utf-8") as file:
        coder = mixture_packing.WordCoder(file.read(), added_tokens=True)
    assert coder.ends is not None
    tokenizer, source = Tokenizer.from_file(PATH), random.Random(12)
    parts = [*"abcdeéßüÿ÷ÃİıſÅ'stremlv.,!?$#`~|<>w/1２ 日́̈\n\t-_@[]{}^", "</w>", "<|endoftext|>", "'ll", "the ", "ing. "]
    for _ in range(20):
        texts = ["".join(source.choice(parts) for _ in range(source.randint(0, 40))) for _ in range(200)]
        for text, packed in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(packed, coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        coder.rest()


def test_other_splits_are_coded_between_marks():
    import json

    with open(PATH, encoding="utf-8") as file:
        definition = json.load(file)
    definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[a-z]+[.,]|[^\s]"
    text = json.dumps(definition)
    coder, tokenizer = mixture_packing.WordCoder(text), Tokenizer.from_str(text)
    assert coder.ends is None
    for words in ("word. word, word word.", "some, other. words."):
        assert np.frombuffer(coder.encode([words.encode()])[0], coder.kind).tolist() == tokenizer.encode(words, add_special_tokens=False).ids
