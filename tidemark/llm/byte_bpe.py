"""Byte-level BPE by backtracking over longest matches, and decoding.

The vocabulary is a rank file. Bytes map to Latin-1 characters, so that the trie of an Aho-Corasick automaton finds the
longest token at any place of a piece. From the left the longest token is taken if it may follow the token before it; else a shorter one is
tried, and where none fits the token before is given up. Whether two tokens may stand side by side depends on the merge
order alone and is memoised, and positions that can't be reached are marked, so the exact result of the merges comes in
time linear in the piece.

Defined results: a null text is empty and has no tokens; rows are coded one by one, so repeated rows give repeated
results. Very long texts and pieces are coded whole. Special tokens are ordinary text. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words remembered per Python worker; beyond it the memory starts afresh.
CACHE_WORDS = 600_000
#: Longer pieces are coded each time.
CACHE_LENGTH = 64

#: A single blank between two characters that aren't white space: no match spans it from the left, one may start at it.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: White space that isn't single or not between characters.
SPACES = re.compile(r"\A\s|\s\s|\s\Z")
#: Marks that are a piece of their own behind a word.
MARKS = frozenset(".,;:!?")
# Fixed value: the pattern that words between blanks may be coded apart for.
BY_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def stand_ins() -> dict[int, str]:
    """Characters that the library classes unlike ``regex`` or ``str.isalpha`` do, with a character of the class it gives them.

    Which are letters, digits and white space depends on the Unicode version of whoever splits. The library is asked once
    in a worker: it codes all characters, one byte a token, by patterns that match a single class.
    """
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    odd = set()
    classes = {}
    for kind, instead in ((r"\p{L}", "é"), (r"\p{N}", "²"), (r"\s", " ")):
        coder = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(coder.encode_ordinary(every)).decode())
        odd |= theirs ^ set(regex.findall(kind, every))
        if kind == r"\p{L}":
            odd |= {c for c in every if c.isalpha()} - theirs
        classes[instead] = theirs
    return {ord(c): next((instead for instead, own in classes.items() if c in own), "§") for c in odd}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class BytePairs:
    """A vocabulary prepared for coding single pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for rank, token in self.bytes.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int | None] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                continue
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                # Only halves that are made earlier and may meet are what the merges join to this token.
                if left in self.halves and right in self.halves and self._may_meet(left, right):
                    self.halves[rank] = (left, right)
                    self.merged[left, right] = rank
                    break
        # A token that no merges lead to is only ever found as a whole piece.
        self.automaton = ahocorasick.Automaton()
        for rank in self.halves:
            token = self.bytes[rank]
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.most = max(map(len, ranks), default=0)

    def _may_meet(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between two tokens that stand side by side.

        Undo the later of the two merges next to the border, again and again: if the tokens that then face each other
        would have been joined before the merge undone last, the border is lost.
        """
        halves, merged = self.halves, self.merged
        bound = 1 << 62
        while True:
            joined = merged.get((left, right))
            if joined is not None and joined < bound:
                return False
            if left > right:
                bound = left
                left = halves[left][1]
                if left == bound:
                    bound = right + 1
                    right = halves[right][0]
                    if right + 1 == bound:
                        return True
            else:
                bound = right + 1
                right = halves[right][0]
                if right + 1 == bound:
                    bound = left
                    left = halves[left][1]
                    if left == bound:
                        return True

    def _shorter(self, rank: int) -> int | None:
        """The longest token that is a proper prefix."""
        if rank not in self.shorter:
            token = self.bytes[rank]
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in prefixes if r is not None and r in self.halves), None)
        return self.shorter[rank]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece, as the merges give them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, text, size, fits = len(piece), piece.decode("latin-1"), self.size, self.fits
        dead: set[int] = set()
        ids: list[int] = []
        at, last, token = 0, -1, self._longest(text, 0)
        while True:
            while token is not None:
                end = at + size[token]
                if end not in dead:
                    if last < 0:
                        break
                    fit = fits.get((last, token))
                    if fit is None:
                        fit = fits[last, token] = self._may_meet(last, token)
                    if fit:
                        break
                token = self._shorter(token)
            if token is not None:
                ids.append(token)
                at = end
                if at == n:
                    return ids
                last, token = token, self._longest(text, at)
            else:
                if last < 0:
                    raise ValueError("a byte is no token of the vocabulary")
                dead.add(at)
                at -= size[ids.pop()]
                token = self._shorter(last)
                last = ids[-1] if ids else -1

    def _longest(self, text: str, at: int) -> int | None:
        """The longest token that starts at a place: the automaton's walk bounds its length."""
        rest = text[at : at + self.most]
        for length in range(self.automaton.longest_prefix(rest), 0, -1):
            found = self.automaton.get(rest[:length], None)
            if found is not None:
                return found
        return None

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Encoder:
    """Splits texts into pieces and codes them, remembering words between two single blanks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pairs = BytePairs(ranks)
        self.pattern = regex.compile(pattern)
        self.by_words = pattern == BY_WORDS
        self.stand_ins = stand_ins()
        self.pieces: dict[str, list[int]] = {}
        self.words: dict[str, tuple[list[int], str]] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, with letters, digits and white space as the library has them."""
        if text.isascii() or self.stand_ins.keys().isdisjoint(map(ord, text)):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def _letters(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or self.stand_ins.keys().isdisjoint(map(ord, word)))

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pairs.encode(piece.encode())
            if len(piece) <= CACHE_LENGTH:
                if len(self.pieces) >= CACHE_WORDS:
                    self.pieces.clear()
                if len(self.pairs.fits) >= 8 * CACHE_WORDS:
                    self.pairs.fits.clear()
                self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> tuple[list[int], str]:
        """Ids of a word with the blank before it, and as text; remembered if the word is short."""
        if self._letters(word):
            ids = self.pairs.encode(b" " + word.encode())
        elif word[-1:] in MARKS and self._letters(word[:-1]):
            stem = self.words.get(word[:-1]) or self._word(word[:-1])
            ids = stem[0] + self._piece(word[-1])
        else:
            ids = list(chain.from_iterable(map(self._piece, self.split(" " + word))))
        known = ids, " ".join(map(str, ids))
        if len(word) <= CACHE_LENGTH:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = known
        return known

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text, and the ids as text joined by blanks."""
        if not text:
            return [], ""
        if not self.by_words:
            # Another pattern may match across blanks.
            ids = list(chain.from_iterable(map(self._piece, self.split(text))))
            return ids, " ".join(map(str, ids))
        first, *rest = BETWEEN.split(text) if SPACES.search(text) else text.split(" ")
        start = list(chain.from_iterable(map(self._piece, self.split(first))))
        known = self.words.get
        found = [(start, " ".join(map(str, start))), *[known(word) or self._word(word) for word in rest]]
        return list(chain.from_iterable([ids for ids, _ in found])), " ".join([text for _, text in found])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(data: bytes, pattern: str) -> Encoder:
    """The worker's encoder; preparing a vocabulary takes a second and is done once."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(data), pattern)
    return _ENCODERS[key]


def _shipped(docs: DataFrame, path: str):
    """The rank file, read by the driver and sent to every executor once; its size doesn't depend on the corpus."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every whole text, in one pass without a shuffle."""
    data = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(data.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [coder.encode(text or "")[0] for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes of every list of ids."""
    data = _shipped(coded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(data.value).items()}
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "data"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def code_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encodes every text and decodes the ids again, in one pass."""
    data = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(data.value, pattern)
        sha = hashlib.sha256
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column("text"):
                ids, written = coder.encode(text.as_py() or "")
                counts.append(len(ids))
                coded.append(sha(written.encode()).hexdigest())
                decoded.append(sha(coder.pairs.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
