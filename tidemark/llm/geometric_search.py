"""Ranked lexical search over posting lists in geometric blocks.

Documents are vectors of term impacts. A shard of documents indexes itself: the posting list of a term is clustered by the
similarity of its documents (projected vectors, nearest of a few centres from the list), and each block keeps the
coordinatewise maximum of its documents' vectors. What a query scores on that summary bounds what it scores on any
document of the block, so a block whose exact bound is below the n-th best score so far is skipped, and nothing else is: the
result is that of scoring every document. Terms are taken by falling impact; once what is left can't reach the n-th best
score, the rest of their lists isn't looked at, and lists that no query of a shard looks at are never clustered.

One pass over the texts finds the terms of queries in every document and writes packed shards; texts, vectors and postings
are never shuffled. Document frequencies are summed up from the shards. A few shards, dealt by hash, are searched first;
their n-th best scores are where the others start. Shards answer with their own n best a query, combined before the last
shuffle. Queries are worked on in blocks of bounded vocabulary, so that memory doesn't depend on their number; very many
queries take several rounds over the documents.

All scores are whole numbers. Equality of terms is that of 64-bit hashes.

Defined results: a null text has no terms. Rows of one item id are one item with the terms of all its rows; items without
terms give no rows. Every row of documents is a document of its own: repeated rows hold places of their own. Equal scores
are in the order of the ids, missing ids last. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, bytes_of, staged
from tidemark.llm.words import LOWER, word_hashes

NEAREST = 10
#: Documents and postings of a shard, and documents of a block.
SHARD_DOCUMENTS, SHARD_POSTINGS = 2_048, 1 << 19
BLOCK = 32
#: Terms of a block of queries, unless a single query has more, and queries' terms of a round over the documents.
BLOCK_TERMS, ROUND_TERMS = 8_192, 1 << 20
#: Every so many shards one is searched first.
FIRST = 32
#: Directions that vectors are projected on for clustering.
DIRECTIONS = 32
#: Bytes of text hashed at a time.
STEP = 1 << 18

#: What ends a term is a blank, A-Z are lower case.
_TERM = LOWER.copy()
_TERM[np.r_[0:0x30, 0x3A:0x41, 0x5B:0x61, 0x7B:0x80]] = 32

SHARDS = "shard long, n_docs long, n_tokens long, ids binary, known binary, lengths binary, sizes binary, terms binary, counts binary"


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every term of UTF-8 texts, in order, and the n + 1 offsets of each document's terms."""
    return word_hashes(_TERM[data], offsets)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Range of rows, term hashes and their offsets, for about STEP bytes of texts at a time."""
    data, offsets = bytes_of(batch.column("text"))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + STEP, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield start, end, *term_hashes(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
        start = end


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The distinct (item_id, term) of all items, stored; terms are hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, hashes, at in _groups(batch):
                row = np.repeat(np.arange(start, end), np.diff(at))
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(row)), pa.array(hashes.view(np.int64))], ["item_id", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return staged(rows.mapInArrow(run, "item_id long, term long").distinct(), "item-terms")


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Shards of documents with the numbers and counts of vocabulary terms, stored.

    n_docs and n_tokens count what has terms at all; documents without any of the vocabulary are only counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base, made = (context.partitionId() if context else 0) << 32, 0
        press = zstandard.ZstdCompressor(level=3)
        held, seen, tokens = [], 0, 0

        def shard() -> pa.RecordBatch:
            joined = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in (zip(*held, strict=True) if held else [()] * 6)]
            ids, known, lengths, sizes, terms, counts = joined
            kinds = (np.int64, np.uint8, np.int64, np.int64, np.uint32, np.int64)
            packed = [press.compress(np.ascontiguousarray(x.astype(k)).tobytes()) for x, k in zip((ids, known, lengths, sizes, terms, counts), kinds, strict=True)]
            values = [[base + made], [seen], [tokens], *([p] for p in packed)]
            types = [pa.int64()] * 3 + [pa.binary()] * 6
            names = [f.split()[0] for f in SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        n_docs = n_postings = 0
        for batch in batches:
            column = batch.column("doc_id")
            ids, known = column.fill_null(LAST_ID).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
            for start, end, hashes, at in _groups(batch):
                lengths = np.diff(at)
                seen, tokens = seen + int((lengths > 0).sum()), tokens + int(lengths.sum())
                number = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
                there = vocabulary[number] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                row = np.repeat(np.arange(end - start, dtype=np.int64), lengths)[there]
                both, counts = np.unique(row << 32 | number[there], return_counts=True)
                row = both >> 32
                rows = np.flatnonzero(np.bincount(row, minlength=end - start))
                sizes = np.bincount(row, minlength=end - start)[rows]
                held.append((ids[start:end][rows], known[start:end][rows], lengths[rows], sizes, both & 0xFFFFFFFF, counts))
                n_docs, n_postings = n_docs + len(rows), n_postings + len(both)
                if n_docs >= SHARD_DOCUMENTS or n_postings >= SHARD_POSTINGS:
                    yield shard()
                    held, made, seen, tokens, n_docs, n_postings = [], made + 1, 0, 0, 0, 0
        yield shard()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return staged(rows.mapInArrow(run, SHARDS), "shards")


class Shard(NamedTuple):
    """Documents of a shard: ids, which are known, lengths, n + 1 offsets of postings, their terms and counts."""

    ids: np.ndarray
    known: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


def _opened(batch: pa.RecordBatch, i: int) -> Shard:
    unpress = zstandard.ZstdDecompressor()
    get = lambda name, kind: np.frombuffer(unpress.decompress(batch.column(name)[i].as_py()), kind)
    starts = np.concatenate([[0], np.cumsum(get("sizes", np.int64))])
    return Shard(get("ids", np.int64), get("known", np.uint8) > 0, get("lengths", np.int64), starts, get("terms", np.uint32), get("counts", np.int64))


def frequencies(shards: DataFrame, n_terms: int) -> np.ndarray:
    """The number of documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("terms")[i].as_py()), np.uint32)
                total += np.bincount(terms, minlength=n_terms)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["term", "n"])

    total = np.zeros(n_terms, np.int64)
    for term, n in shards.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).toLocalIterator():
        total[term] = n
    return total


def weights(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


class Queries(NamedTuple):
    """A block of queries: their numbers, n + 1 offsets, terms as columns of the block, and the columns' vocabulary numbers."""

    numbers: np.ndarray
    starts: np.ndarray
    columns: np.ndarray
    vocabulary: np.ndarray


def in_blocks(numbers: np.ndarray, terms: np.ndarray) -> list[Queries]:
    """Queries (number and term of each of their terms, by number) in blocks of at most BLOCK_TERMS terms."""
    cuts = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist() + [len(numbers)]
    blocks, first = [], 0
    for last in range(1, len(cuts)):
        if last + 1 == len(cuts) or cuts[last + 1] - cuts[first] > BLOCK_TERMS:
            a, b = cuts[first], cuts[last]
            vocabulary, columns = np.unique(terms[a:b], return_inverse=True)
            blocks.append(Queries(numbers[cuts[first:last]], np.array(cuts[first : last + 1]) - a, columns, vocabulary))
            first = last
    return blocks


class Index:
    """The documents of a shard for a block of queries: dense impacts, and posting lists that are clustered when first used."""

    def __init__(self, shard: Shard, queries: Queries, weight: np.ndarray, n_docs: int, n_tokens: int):
        held = np.isin(shard.terms, queries.vocabulary)
        row = np.repeat(np.arange(len(shard.ids)), np.diff(shard.starts))[held]
        column = np.searchsorted(queries.vocabulary, shard.terms[held])
        m = 10 + (90 * shard.lengths * n_docs) // n_tokens
        count = shard.counts[held]
        impact = weight[queries.vocabulary][column] * ((1_000_000_000 * count) // (1000 * count + 8 * m[row]))
        self.impacts = np.zeros((len(shard.ids), len(queries.vocabulary)), np.int64)
        self.impacts[row, column] = impact
        order = np.argsort(column, kind="stable")
        self._rows, self._ends = row[order], np.searchsorted(column[order], np.arange(len(queries.vocabulary) + 1))
        self.most = self.impacts.max(axis=0, initial=0)
        self._queries, self._blocks = queries, {}
        self._places, self._columns_of = None, None

    def _projected(self) -> np.ndarray:
        """Unit vectors on random directions: close ones are similar documents."""
        if self._places is None:
            source = np.random.default_rng(7)
            directions = source.choice(np.array([-1.0, 1.0], np.float32), (self.impacts.shape[1], DIRECTIONS))
            places = np.empty((len(self.impacts), DIRECTIONS), np.float32)
            for a in range(0, len(places), 512):
                places[a : a + 512] = self.impacts[a : a + 512].astype(np.float32) @ directions
            self._places = places / np.maximum(np.linalg.norm(places, axis=1, keepdims=True), 1e-9)
        return self._places

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A term's posting list in blocks: rows, n + 1 offsets, summaries, and the columns that these hold.

        Summaries hold the columns of all queries with the term; no other query looks at the list.
        """
        if term not in self._blocks:
            rows = self._rows[self._ends[term] : self._ends[term + 1]]
            if len(rows) > BLOCK:
                # The centres are documents of the list, evenly spread over it; the nearest one takes a document.
                places = self._projected()[rows]
                centres = places[:: BLOCK // 2]
                nearest = np.concatenate([(places[a : a + 1024] @ centres.T).argmax(axis=1) for a in range(0, len(rows), 1024)])
                order = np.argsort(nearest, kind="stable")
                rows, nearest = rows[order], nearest[order]
                begin = np.flatnonzero(np.diff(nearest, prepend=-1))
                # A cluster that is too large goes on in the next block.
                inside = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
                starts = np.append(np.flatnonzero(inside % BLOCK == 0), len(rows))
            else:
                starts = np.arange(len(rows) + 1)
            columns = self._of_queries_with(term)
            if len(rows) > BLOCK:
                summaries = np.empty((len(starts) - 1, len(columns)), np.int64)
                for b in range(len(starts) - 1):
                    summaries[b] = self.impacts[np.ix_(rows[starts[b] : starts[b + 1]], columns)].max(axis=0)
            else:
                # Few documents are blocks of one, which are their own summaries.
                summaries = self.impacts[np.ix_(rows, columns)]
            self._blocks[term] = rows, starts, summaries, columns
        return self._blocks[term]

    def _of_queries_with(self, term: int) -> np.ndarray:
        q = self._queries
        if self._columns_of is None:
            owner = np.repeat(np.arange(len(q.numbers)), np.diff(q.starts))
            order = np.argsort(q.columns, kind="stable")
            self._columns_of = owner[order], np.searchsorted(q.columns[order], np.arange(len(q.vocabulary) + 1))
        owners, ends = self._columns_of
        return np.unique(np.concatenate([q.columns[q.starts[o] : q.starts[o + 1]] for o in owners[ends[term] : ends[term + 1]].tolist()]))


def search(index: Index, shard: Shard, terms: np.ndarray, start: int, n: int) -> tuple[list[tuple[int, int]], int, int]:
    """The best n (score, row) of a query from ``start`` on, and how many blocks were skipped and how many looked into.

    A document with the score that the n-th best has may still come before it by its id, so only lower bounds are skipped.
    """
    most = index.most[terms]
    order = np.argsort(-most, kind="stable")
    rest = np.cumsum(most[order][::-1])[::-1]
    found_rows, found_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    floor, skipped, entered = max(1, start), 0, 0
    for place, left in zip(order.tolist(), rest.tolist(), strict=True):
        if left < floor:
            break
        rows, starts, summaries, columns = index.blocks(int(terms[place]))
        if not len(rows):
            continue
        own = np.searchsorted(columns, terms)
        bounds = summaries[:, own].sum(axis=1)
        # The most promising blocks first, a few at a time: the n-th best score rises early.
        by_bound = np.argsort(-bounds, kind="stable")
        at, some = 0, 4
        while at < len(by_bound) and bounds[by_bound[at]] >= floor:
            chosen = by_bound[at : at + some]
            chosen = chosen[bounds[chosen] >= floor]
            sizes = starts[chosen + 1] - starts[chosen]
            picked = rows[np.repeat(starts[chosen] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            picked = np.setdiff1d(picked, found_rows)
            scores = index.impacts[np.ix_(picked, terms)].sum(axis=1)
            good = scores >= floor
            found_rows, found_scores = np.concatenate([found_rows, picked[good]]), np.concatenate([found_scores, scores[good]])
            if len(found_rows) > n:
                best = np.lexsort((shard.ids[found_rows], -found_scores))[:n]
                found_rows, found_scores = found_rows[best], found_scores[best]
            if len(found_rows) >= n:
                floor = max(floor, int(found_scores.min()))
            entered += len(chosen)
            at, some = at + some, some * 2
        skipped += max(0, len(by_bound) - at)
    return list(zip(found_scores.tolist(), found_rows.tolist(), strict=True)), skipped, entered


def answers(
    shards: DataFrame, blocks: list[Queries], names: list, weight: np.ndarray, n_docs: int, n_tokens: int, floors: dict, n: int
) -> DataFrame:
    """(item_id, score, doc_id): the n best of every shard and item, not below the items' floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = _opened(batch, i)
                if not len(shard.ids):
                    continue
                for queries in blocks:
                    index = Index(shard, queries, weight, n_docs, n_tokens)
                    out = []
                    for q, number in enumerate(queries.numbers.tolist()):
                        terms = queries.columns[queries.starts[q] : queries.starts[q + 1]]
                        found, *_ = search(index, shard, terms, floors.get(names[number], 0), n)
                        out += [(names[number], s, int(shard.ids[r]) if shard.known[r] else None) for s, r in found]
                    columns = list(zip(*out, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "score", "doc_id"])

    return shards.mapInArrow(run, "item_id long, score long, doc_id long")


def _best(found: DataFrame, n: int) -> DataFrame:
    """The n best of every item; Spark cuts the rows of each task to n an item before it shuffles them."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    n: int = NEAREST,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the n documents that score highest for every item."""
    wanted = item_terms(items, item_id, item_text)
    rounds = max(1, -(-wanted.count() // ROUND_TERMS))

    def turn(number: int) -> DataFrame:
        own = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == number)
        return _round(docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")), own, n)

    best = _best(reduce(DataFrame.union, map(turn, range(rounds))), n)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _round(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(item_id, score, doc_id) of all shards' best for the items at hand, whose terms the driver can hold."""
    pairs = wanted.orderBy("item_id", "term").toArrow()
    items = pairs.column("item_id").to_pylist()
    terms = pairs.column("term").to_numpy().astype(np.int64).view(np.uint64)
    names = list(dict.fromkeys(items))
    known = {name: i for i, name in enumerate(names)}
    vocabulary = np.unique(terms)
    blocks = in_blocks(np.array([known[i] for i in items], np.int64), np.searchsorted(vocabulary, terms))
    shards = vectors(docs, vocabulary)
    n_docs, n_tokens = shards.agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    weight = weights(frequencies(shards, len(vocabulary)), n_docs or 0)
    answer = lambda some, floors: answers(some, blocks, names, weight, n_docs, n_tokens, floors, n)
    first = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
    early = staged(answer(shards.where(first), {}), "first-answers")
    floors = {r["item_id"]: r["score"] for r in _best(early, n).where(F.col("rank") == n).collect()}
    return early.union(answer(shards.where(~first), floors))
