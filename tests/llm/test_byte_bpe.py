import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "  ", "a  b", " a\n\n b", "a \n b \t\tc", "x\x1cy \x1c z", "a\x85 b\xa0 c", "日本語 テスト 😀😀 é́", "a" * 5000, "ab" * 3000 + "'s 're don't  ",
    "\n \n \n x", "1234567890 !!! $$$ ***", "   leading", "trailing   \n", "\x1c\x1d a\x1e b", "<|endoftext|> text", "word. word, WORD! w.w",
]


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return byte_bpe.encoder_of(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.pairs.ranks, special_tokens={})


def test_equals_merges_on_odd_texts(coder, reference):
    source = random.Random(1)
    texts = ODD + ["".join(source.choice(" \n\t\x1c\xa0abTHE'st12!$é日") for _ in range(source.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        ids, written = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert written == " ".join(map(str, ids))
        assert coder.pairs.decode(ids) == text.encode()


def test_equals_naive_merges_on_random_vocabularies():
    source = random.Random(8)
    for _ in range(30):
        ranks = {bytes([b]): i for i, b in enumerate(b"abc")}
        while len(ranks) < 20:
            token = source.choice(list(ranks)) + source.choice(list(ranks))
            ranks.setdefault(token, len(ranks))
        pairs = byte_bpe.BytePairs(ranks)
        reachable = {pairs.bytes[r]: r for r in pairs.halves}
        for _ in range(50):
            piece = bytes(source.choice(b"abc") for _ in range(source.randint(1, 30)))
            parts = [bytes([b]) for b in piece]
            while True:
                best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
                if best is None:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            if len(reachable) == len(ranks) and piece not in ranks:
                assert pairs.encode(piece) == [ranks[p] for p in parts]


def test_memory_that_starts_afresh_changes_nothing(coder, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 3)
    text = " ".join(f"word{i % 11} and, other{i % 7}." for i in range(200))
    assert byte_bpe.Encoder(coder.pairs.ranks, public_tokenizers.PATTERN).encode(text)[0] == reference.encode_ordinary(text)


def test_round_trip_over_tables(frame, rows, corpus, reference):
    df = frame(corpus, "doc_id long, text string")
    want = []
    for i, t in corpus:
        ids = reference.encode_ordinary(t or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode()))
        want.append((i, len(ids), *digests))
    assert rows(byte_bpe.code_digests(df, PATH, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    coded = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    back = sorted(((r["doc_id"], bytes(r["data"]).decode()) for r in byte_bpe.decode(coded, PATH).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in corpus), key=repr)


def test_empty_table(frame):
    empty = frame([], "doc_id long, text string")
    assert byte_bpe.code_digests(empty, PATH, public_tokenizers.PATTERN).collect() == []


def test_rank_file_lines():
    assert byte_bpe.read_ranks(base64.b64encode(b"ab") + b" 7\n\n") == {b"ab": 7}


def test_every_character_has_the_library_s_class(coder, reference):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(every), 4096):
        own = every[start : start + 4096]
        text = " ".join(f".{c}'s" for c in own)
        if coder.encode(text)[0] != reference.encode_ordinary(text):
            raise AssertionError([c for c in own if coder.encode(f".{c}'s")[0] != reference.encode_ordinary(f".{c}'s")])
    for form in ("{}'s", "a{}b 1{}2", " {}"):
        text = " ".join(form.replace("{}", chr(c)) for c in byte_bpe.stand_ins())
        assert coder.encode(text)[0] == reference.encode_ordinary(text)


def test_characters_of_other_unicode_versions(coder, reference):
    odd = [chr(c) for c in byte_bpe.stand_ins()]
    source = random.Random(5)
    parts = [*"ab .,!'s12é  \n", "'re", "word", *source.sample(odd, min(20, len(odd)))]
    for _ in range(2000):
        text = "".join(source.choice(parts) for _ in range(source.randint(1, 25)))
        assert coder.encode(text)[0] == reference.encode_ordinary(text), text


def test_other_patterns_may_match_across_blanks(coder):
    pattern = r"[a-z]+ [a-z]+|\s+|[^\sa-z]+|[a-z]+"
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=coder.pairs.ranks, special_tokens={})
    own = byte_bpe.Encoder(coder.pairs.ranks, pattern)
    for text in ("one two three four", "a b. c d, e 12 f", "no\nbreak here"):
        assert own.encode(text)[0] == library.encode_ordinary(text)
