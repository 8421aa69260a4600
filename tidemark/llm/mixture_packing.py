"""Packing of tokenised documents into fixed-length sequences whose sources keep their target proportions.

Each source is a queue of tokens. A sequence (window) is filled by deficit round-robin: every queue earns its share of the
window as credit, whole tokens are served, seats left over go to the largest credits, and what a queue is owed or ahead by
is carried to the next window. The targets are the sources' shares of all tokens, so all queues end together and every
token is packed. Documents are cut where a queue's turn ends.

Windows are worked on in blocks. How far each queue is at the border of a block follows from the totals alone (the tokens
with the smallest virtual finishing times come first), so any task computes the credits carried into a block without the
blocks before it. The driver holds one total per queue, that of the QUEUES - 1 largest sources.

All further sources share a part of each window that is in proportion to what they hold. Who has its turn there is settled
by a tree of at most FAN children a node, sources or nodes of sources: children give turns of tokens in the order of their
virtual finishing times. A place in a source becomes one in its node, and so on up to the shared part, by the totals
of the nodes on the way alone, and these are a table of which a row gets what its sources need. So every source keeps its
proportion, however many there are, to within a turn (1/256 of a window) a level.

Tokens that don't fill a last window become sequences whose lengths are powers of two, which need no padding.

Defined results: a null text is empty and is packed as its end token alone. A null source is a source of its own. Ids are
carried along: repeated rows and rows without an id are packed like any other. Empty tables give no rows; other columns
are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import shuffle_width, staged, texts_of

LENGTH = 4096
#: Windows in a block.
BLOCK = 64
QUEUES = 256
#: Children of a node at most, in the tree of the sources that have no queue of their own.
FAN = 32
#: Turns whose places are worked out at a time.
TURNS = 16_384
#: Words remembered in a task, some 250 bytes each, and those met again that a Python worker keeps between tasks.
CACHE_WORDS, KEPT_WORDS = 800_000, 300_000
#: Bytes of text whose words are listed at a time.
STEP = 4 << 20
CACHE_LENGTH = 64
#: Bytes of text in a row of the token table, unless a single document is longer.
ROW_BYTES = 8 << 20
#: Words looked up in one call of the tokenizer.
CALL = 4096

# Fixed value: the split of tokenizers that keep letters whole, digits single and marks together.
LETTERS_WHOLE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of Latin letters that no normal form changes, and the ASCII marks that may stand behind them.
PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class WordCoder:
    """Ids of texts by a tokenizer that drops white space: words are coded once and remembered.

    With ``added_tokens`` the strings of the file's added tokens give their ids, as the tokenizer has it by default.
    """

    def __init__(self, definition: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.plain: Tokenizer | None = None
        self.added: dict[bytes, int] = {}
        self.parts: re.Pattern | None = None
        tokens = json.loads(definition).get("added_tokens") or [] if added_tokens else []
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or not t["special"] for t in tokens):
            self.plain = Tokenizer.from_str(definition)
        elif tokens:
            # They are looked for in the raw text, before anything else; of those at one place the longest counts.
            self.added = {t["content"].encode(): t["id"] for t in tokens}
            self.parts = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")")
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[bytes, bytes] = {}
        self.again: set[bytes] = set()
        # A character that is one token by itself parts new words, so that many are coded in one call.
        alone = ((c, self._ids(c)) for c in "`^~|")
        self.mark, self.mark_id = next(((c, ids[0]) for c, ids in alone if len(ids) == 1), (None, -1))
        # Where letters stay whole and the last token of a word tells so, plain words need no mark between them.
        model = json.loads(definition)
        suffix = model["model"].get("end_of_word_suffix") or ""
        steps = (model.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split = [(t.get("pattern") or {}).get("Regex") for t in steps if t["type"] == "Split" and t["behavior"] == "Removed" and t["invert"]]
        self.ends: np.ndarray | None = None
        if suffix and [t["type"] for t in steps] == ["Split", "ByteLevel"] and split == [LETTERS_WHOLE] and not steps[1]["use_regex"]:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True

    def _ids(self, text: str) -> list[int]:
        # The fast form keeps no offsets, which nobody asks for here.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def rest(self) -> None:
        """Forgets, when a task ends, all words but those that were met again."""
        self.known = {w: self.known[w] for w in self.again if w in self.known}
        self.again = set()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as packed numbers of ``kind``."""
        if self.plain:
            return [np.array(self.plain.encode(t.decode(), add_special_tokens=False).ids, self.kind).tobytes() for t in texts]
        cut = {i: self.parts.split(t) for i, t in enumerate(texts) if any(a in t for a in self.added)}
        if not cut:
            return self._encode(texts)
        # Every other part is an added token.
        coded = iter(self._encode([part for i, t in enumerate(texts) for part in cut.get(i, [t])[::2]]))
        packed = []
        for i in range(len(texts)):
            ids = [next(coded)]
            for token in cut.get(i, [])[1::2]:
                ids += [np.array([self.added[token]], self.kind).tobytes(), next(coded)]
            packed.append(b"".join(ids))
        return packed

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        packed, first, held = [], 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= STEP or i == len(texts) - 1:
                packed += self._some(texts[first : i + 1])
                first, held = i + 1, 0
        return packed

    def _some(self, texts: list[bytes]) -> list[bytes]:
        # The tokenizer lower-cases; doing so for A-Z first means fewer words, but must not come before a combining mark.
        words = [(t if b"\xcc" in t or b"\xcd" in t else t.lower()).split() for t in texts]
        here = set().union(*words)
        new = here.difference(self.known)
        before = here - new
        if len(self.again) < KEPT_WORDS:
            self.again |= before
        if len(self.known) > CACHE_WORDS:
            # What was met again goes on being remembered: most of it is frequent.
            self.known = {w: self.known[w] for w in self.again | before if w in self.known}
        known, fresh = self.known, list(new)
        known.update(self._coded(fresh))
        packed = [b"".join(map(known.__getitem__, ws)) for ws in words]
        for word in fresh:
            if len(word) > CACHE_LENGTH:
                del known[word]
        return packed

    def _coded(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        if self.ends is None:
            yield from self._marked(words)
            return
        # Letters and the marks behind them are coded apart, so that a word with and without a mark is one piece of work.
        stems = [word.rstrip(MARKS) for word in words]
        plain = [stem.isalpha() or PLAIN(stem) is not None for stem in stems]
        distinct = set(compress(stems, plain))
        new = distinct.difference(self.known)
        pieces = dict(self._plain_words(list(new)))
        pieces.update((stem, self.known[stem]) for stem in distinct - new)
        tails = {b"": b""}
        for word, stem in zip(compress(words, plain), compress(stems, plain), strict=True):
            tail = word[len(stem) :]
            if tail not in tails:
                tails.update(self._marked([tail]))
            yield word, pieces[stem] + tails[tail]
        if not all(plain):
            yield from self._marked([word for word, known in zip(words, plain, strict=True) if not known])

    def _plain_words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Codes of words of letters: each ends with the only token of it that has the suffix of word ends."""
        for i in range(0, len(words), CALL):
            some = words[i : i + CALL]
            ids = np.array(self._ids(b" ".join(some).decode()), self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                packed, bounds = ids.tobytes(), (np.append(0, ends) * ids.itemsize).tolist()
                for word, a, b in zip(some, bounds[:-1], bounds[1:], strict=True):
                    yield word, packed[a:b]
            else:
                yield from self._marked(some)

    def _marked(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Codes of any words, told apart by a mark between them."""
        for i in range(0, len(words), CALL):
            yield from self._between_marks(words[i : i + CALL])

    def _between_marks(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        mark = (self.mark or "").encode()
        # Without a mark nothing is joint: the empty string is in every word.
        joint = [w for w in words if mark not in w]
        own = words if not joint else [w for w in words if mark in w] if len(joint) < len(words) else []
        if joint:
            ids = np.array(self._ids((b" " + mark + b" ").join(joint).decode()), self.kind)
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) == len(joint) - 1:
                packed, size = ids.tobytes(), ids.itemsize
                starts, ends = (np.append(0, marks + 1) * size).tolist(), (np.append(marks, len(ids)) * size).tolist()
                for word, a, b in zip(joint, starts, ends, strict=True):
                    yield word, packed[a:b]
            else:
                own = words
        for word in own:
            yield word, np.array(self._ids(word.decode()), self.kind).tobytes()


@lru_cache(maxsize=2)
def _coder(definition: str, added_tokens: bool = False) -> WordCoder:
    return WordCoder(definition, added_tokens)


class Mixture:
    """Who is served what in which window, given how many tokens each queue holds and how many the shared part."""

    def __init__(self, totals: list[int], length: int = LENGTH, block: int = BLOCK, shared: int = 0):
        self.totals, self.length, self.block, self.shared = totals, length, block, shared
        self.own = sum(totals)
        self.total = self.own + shared
        self.windows = self.total // length
        self.blocks = -(-self.windows // block)
        self.border = lru_cache(maxsize=4096)(self._border)
        self.served = lru_cache(maxsize=64)(self._served)

    def given(self, w: int) -> int:
        """Tokens of the shared part before a window: its proportion, rounded. They come first in a window."""
        return (2 * w * self.length * self.shared + self.total) // (2 * self.total) if self.shared else 0

    def edge(self, w: int) -> int:
        """Tokens that the queues have given before a window."""
        return w * self.length - self.given(w)

    def _border(self, n: int) -> list[int]:
        """Tokens each queue has given when n tokens are served: those with the smallest (i + 1/2) / total, ties in order."""
        if n >= self.own:
            return list(self.totals)
        # At time m / 2**64 a queue has served round(total * m / 2**64) tokens.
        at = lambda m: [(t * m + (1 << 63)) >> 64 for t in self.totals]
        low, high = 0, 1 << 64
        while low < high:
            middle = (low + high) // 2
            if sum(at(middle)) >= n:
                high = middle
            else:
                low = middle + 1
        now = at(low)
        earlier = at(low - 1) if low else [0] * len(now)
        extra = sum(now) - n
        for s in range(len(now) - 1, -1, -1):
            back = min(extra, now[s] - earlier[s])
            now[s] -= back
            extra -= back
        return now

    def _served(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """For the windows of a block: where each queue's turn starts in the queue (one row more), and in the window."""
        first = b * self.block
        k = min(self.block, self.windows - first)
        begin = np.array(self.border(self.edge(first)), np.int64)
        left = np.array(self.border(self.edge(first + k)), np.int64) - begin
        seats_of = np.diff([self.edge(first + w) for w in range(k + 1)])
        quantum, credit = left.copy(), np.zeros(len(left), np.int64)  # in tokens times k
        taken = np.zeros((k, len(left)), np.int64)
        for w in range(k):
            credit += quantum
            if w == k - 1:
                take = left.copy()
            else:
                take = np.clip(credit // k, 0, left)
                seats = int(seats_of[w]) - int(take.sum())
                while seats:
                    # One more token for the largest credits, or one less for the smallest.
                    owed = credit - take * k
                    able = np.flatnonzero(take < left) if seats > 0 else np.flatnonzero(take > 0)
                    able = able[np.argsort(-owed[able] if seats > 0 else owed[able], kind="stable")][: abs(seats)]
                    take[able] += 1 if seats > 0 else -1
                    seats -= len(able) if seats > 0 else -len(able)
            credit -= take * k
            left -= take
            taken[w] = take
        starts = begin + np.concatenate([np.zeros((1, len(left)), np.int64), np.cumsum(taken, axis=0)])
        return starts, np.cumsum(taken, axis=1) - taken + (self.length - seats_of)[:, None]

    def _tail(self) -> list[int]:
        rest = self.total - self.windows * self.length
        return [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]

    def pieces(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the document, length, sequence, offset) of a document that starts at a place of its queue."""
        at, end = start, start + n
        while at < end and self.blocks:
            b = min(self.blocks - 1, at * self.blocks // max(1, self.totals[queue]))
            while b and self._begin(b)[queue] > at:
                b -= 1
            while b < self.blocks and self._begin(b + 1)[queue] <= at:
                b += 1
            if b == self.blocks:
                break
            starts, offsets = self.served(b)
            column = starts[:, queue]
            w = int(np.searchsorted(column, at, side="right")) - 1
            while at < end and w < len(offsets):
                stop = min(end, int(column[w + 1]))
                if stop > at:
                    yield at - start, stop - at, b * self.block + w, int(offsets[w, queue]) + at - int(column[w])
                    at = stop
                w += 1
        if at < end:
            yield from self._in_tail(queue, at, end, start)

    def _begin(self, b: int) -> list[int]:
        return self.border(self.edge(min(b * self.block, self.windows)))

    def _in_tail(self, queue: int, at: int, end: int, start: int) -> Iterator[tuple[int, int, int, int]]:
        full = self.border(self.edge(self.windows))
        before = sum(t - f for t, f in zip(self.totals[:queue], full[:queue], strict=True)) + at - full[queue]
        yield from self._seats(self.shared - self.given(self.windows) + before, at, end, start)

    def _seats(self, place: int, at: int, end: int, start: int) -> Iterator[tuple[int, int, int, int]]:
        before = 0
        for i, size in enumerate(self._tail()):
            while at < end and place < before + size:
                step = min(end - at, before + size - place)
                yield at - start, step, self.windows + i, place - before
                at, place = at + step, place + step
            before += size

    def shared_pieces(self, start: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Like ``pieces``, for tokens that start at a place of the shared part."""
        at, end = start, start + n
        while at < end:
            w = (self.total * (2 * at + 1) - 1) // (2 * self.length * self.shared)  # the last with given(w) <= at
            if w >= self.windows:
                yield from self._seats(at - self.given(self.windows), at, end, start)
                return
            stop = min(end, self.given(w + 1))
            yield at - start, stop - at, w, at - self.given(w)
            at = stop


def node_places(totals: np.ndarray, turn: int, child: int, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of a child's tokens come in its node, in order: places and lengths of runs.

    A child with m turns gives its turn q at the time (q + 1/2) / m; of equal times the first child's comes first.
    """
    ends = starts + sizes
    first = starts // turn
    counts = (ends - 1) // turn - first + 1
    which = np.repeat(np.arange(len(starts)), counts)
    q = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    low, high = np.maximum(q * turn, starts[which]), np.minimum((q + 1) * turn, ends[which])
    turns = -(-totals // turn)
    own = int(turns[child])
    # Products of two numbers of turns; beyond 64 bits as Python numbers.
    kind = np.int64 if 4 * int(turns.max()) ** 2 < 1 << 63 else object
    later = (np.arange(len(totals)) > child).astype(np.int64)
    places = low - q * turn
    for i in range(0, len(q), TURNS):
        times = (2 * q[i : i + TURNS, None] + 1).astype(kind) * turns.astype(kind)
        earlier = ((times - later) // own + 1) // 2
        earlier[:, child] = q[i : i + TURNS]
        places[i : i + TURNS] += np.minimum(earlier * turn, totals).sum(axis=1).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + (high - low)[:-1]]))
    return places[new], np.add.reduceat(high - low, new)


class Tree:
    """The order of sources in the shared part; ``nodes`` has totals of children by level and number of a node."""

    def __init__(self, depth: int, fan: int, length: int, root: list[int]):
        self.depth, self.fan, self.turn = depth, fan, max(1, length // 256)
        self.nodes: dict[tuple[int, int], np.ndarray] = {}
        self.root = np.array(root, np.int64)

    def runs(self, rank: int, start: int, n: int) -> list[tuple[int, int]]:
        """Places in the shared part, and lengths, of tokens of the source with this rank."""
        starts, sizes = np.array([start], np.int64), np.array([n], np.int64)
        for level in range(self.depth - 1, -1, -1):
            number, child = divmod(rank // self.fan ** (self.depth - 1 - level), self.fan)
            totals = self.nodes[level, number] if level else self.root
            starts, sizes = node_places(totals, self.turn, child, starts, sizes)
        return list(zip(starts.tolist(), sizes.tolist(), strict=True))


def tokenised(
    docs: DataFrame,
    definition: str,
    end: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    added_tokens: bool = False,
) -> DataFrame:
    """Rows of many documents: ids, sources and packed tokens, each document closed by ``end``; in the shared folder."""
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped.value, added_tokens)
        last = np.array([end], coder.kind).tobytes()
        press = zstandard.ZstdCompressor(level=1)
        context = TaskContext.get()
        base, n = (context.partitionId() if context else 0) << 32, 0
        for batch in batches:
            ids, sources = batch.column("doc_id").to_pylist(), batch.column("source").to_pylist()
            texts, held, first = [], 0, 0
            for i, text in enumerate(texts_of(batch)):
                texts.append(text)
                held += len(text)
                if held >= ROW_BYTES or i == batch.num_rows - 1:
                    coded = [c + last for c in coder.encode(texts)]
                    counts = [len(c) // len(last) for c in coded]
                    own = sources[first : i + 1]
                    tokens: dict[str | None, int] = {}
                    for s, c in zip(own, counts, strict=True):
                        tokens[s] = tokens.get(s, 0) + c
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([base + n], pa.int64()),
                            pa.array([ids[first : i + 1]], pa.list_(pa.int64())),
                            pa.array([own], pa.list_(pa.string())),
                            pa.array([counts], pa.list_(pa.int64())),
                            pa.array([press.compress(b"".join(coded))], pa.binary()),
                            pa.array([[{"source": s, "n": c} for s, c in tokens.items()]], TOKENS),
                        ],
                        ["row", "ids", "sources", "counts", "tokens", "held"],
                    )
                    texts, held, first, n = [], 0, i + 1, n + 1
        coder.rest()

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")
    )
    schema = (
        "row long, ids array<long>, sources array<string>, counts array<long>, tokens binary, "
        "held array<struct<source: string, n: long>>"
    )
    return staged(rows.mapInArrow(run, schema), "tokens")


TOKENS = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    + [("sequence_id", pa.int64()), ("offset", pa.int64())]
)
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    path: str,
    end: int,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece of every document; ``path`` is a tokenizer file the driver reads. ``with_ids`` adds the ids.

    ``added_tokens`` codes the strings of the file's added tokens in texts as these, else they are split like other text.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    rows = tokenised(docs, definition, end, id_col, text_col, source_col, added_tokens)
    held = rows.select("row", F.explode("held").alias("h")).select("row", "h.source", "h.n")
    totals = held.groupBy("source").agg(F.sum("n").alias("n"))
    grand = totals.agg(F.sum("n")).first()[0] or 0
    largest = [(r["source"], r["n"]) for r in totals.orderBy(F.desc("n"), "source").limit(QUEUES - 1).collect()]
    queue_of = {source: i for i, (source, _) in enumerate(largest)}
    mixture = [n for _, n in largest]
    rest = grand - sum(mixture)
    numbers = docs.sparkSession.createDataFrame(
        [(s, i) for s, i in queue_of.items()], "source string, queue int"
    )
    # Where each row's share of a queue starts: the tokens that rows before it hold. One line per row and queue.
    by_source = held.withColumnRenamed("source", "name")
    by_source = by_source.join(F.broadcast(numbers), by_source["name"].eqNullSafe(numbers["source"]), "left").drop("source")
    starts = (
        by_source.where("queue IS NOT NULL")
        .withColumn("start", _held_before("queue"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("queue", "start")).alias("starts"))
    )
    tree, shares = _shared(totals, by_source.where("queue IS NULL").drop("queue"), len(largest), length) if rest else (None, None)
    kind = _coder(definition, added_tokens).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mix = _mixture(tuple(mixture), length, rest)
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sources, counts, tokens, starts = (batch.column(c)[i].as_py() for c in ("ids", "sources", "counts", "tokens", "starts"))
                tokens = np.frombuffer(unpress.decompress(tokens), kind).astype("<u4")
                at = {s["queue"]: s["start"] for s in starts or []}
                ranks: dict[str | None, int] = {}
                if tree:
                    for s in batch.column("shares")[i].as_py() or []:
                        ranks[s["name"]] = s["rank"]
                        at["shared", s["name"]] = s["start"]
                    tree.nodes = _nodes(batch.column("nodes")[i])
                found: list[tuple] = []
                begin = 0
                for doc, source, n in zip(ids, sources, counts, strict=True):
                    queue = queue_of.get(source, ("shared", source))
                    own = memoryview(tokens[begin : begin + n]).cast("B")
                    if source in queue_of:
                        pieces = mix.pieces(queue, at[queue], n)
                    else:
                        pieces = _in_runs(mix, tree.runs(ranks[source], at[queue], n))
                    for start, size, sequence, offset in pieces:
                        part = own[4 * start : 4 * (start + size)]
                        row = (doc, start, size, zlib.crc32(part), n, sequence, offset)
                        found.append((*row, part.cast("I").tolist()) if with_ids else row)
                    at[queue] += n
                    begin += n
                    if len(found) >= 50_000:
                        yield _pieces(found, schema)
                        found = []
                if found:
                    yield _pieces(found, schema)

    schema = PIECES.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else PIECES
    placed = rows.drop("held").repartition(shuffle_width(docs.sparkSession), "row").join(starts, "row", "left")
    for share in shares or []:
        placed = placed.join(share, "row", "left")
    return placed.mapInArrow(run, PIECES_DDL + (", ids array<long>" if with_ids else ""))


def _held_before(key: str) -> Column:
    """Tokens of the same queue or source that rows before this one hold."""
    before = Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(before), F.lit(0))


def _shared(totals: DataFrame, held: DataFrame, first: int, length: int) -> tuple[Tree, list[DataFrame]]:
    """The tree of the sources from rank ``first`` on; by row, ranks and starts of its sources and the nodes they need."""
    ranked = totals.orderBy(F.desc("n"), "source").rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1] - first))
    ranked = staged(ranked.toDF("source string, n long, rank long").where("rank >= 0"), "sources")
    count, depth = ranked.count(), 1
    while FAN**depth < count:
        depth += 1
    number = lambda level: F.expr(f"rank div {FAN ** (depth - level)}")
    # The totals of the children of every node; the root's go with the tree.
    levels = []
    for level in range(depth):
        children = ranked.groupBy(number(level + 1).alias("child")).agg(F.sum("n").alias("n"))
        node = children.groupBy(F.expr(f"child div {FAN}").alias("number"))
        levels.append(node.agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("c")).select(F.lit(level).alias("level"), "number", "c.n"))
    tree = Tree(depth, FAN, length, levels[0].first()["n"])
    shares = held.withColumn("start", _held_before("name"))
    shares = shares.join(ranked.select("source", "rank"), shares["name"].eqNullSafe(ranked["source"])).select("row", "name", "rank", "start")
    out = [shares.groupBy("row").agg(F.collect_list(F.struct("name", "rank", "start")).alias("shares"))]
    needed = [
        shares.select("row", number(level).alias("number")).distinct().join(levels[level], "number")
        for level in range(1, depth)
    ]
    if needed:
        every = reduce(DataFrame.unionByName, needed)
        out.append(every.groupBy("row").agg(F.collect_list(F.struct("level", "number", "n")).alias("nodes")))
    else:
        out[0] = out[0].withColumn("nodes", F.expr("CAST(NULL AS array<struct<level: int, number: bigint, n: array<bigint>>>)"))
    return tree, out


def _nodes(column: pa.ListScalar) -> dict[tuple[int, int], np.ndarray]:
    if not column.is_valid:
        return {}
    level, number, totals = (column.values.field(k) for k in ("level", "number", "n"))
    return {(a, b): t.values.to_numpy() for a, b, t in zip(level.to_pylist(), number.to_pylist(), totals, strict=True)}


def _in_runs(mix: Mixture, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    done = 0
    for place, n in runs:
        for start, size, sequence, offset in mix.shared_pieces(place, n):
            yield done + start, size, sequence, offset
        done += n


def _pieces(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)


@lru_cache(maxsize=4)
def _mixture(totals: tuple[int, ...], length: int, shared: int) -> Mixture:
    return Mixture(list(totals), length, shared=shared)
