"""Removal of repeated byte strings by sorting suffixes, deep-shallow, over a corpus.

A byte goes if a string of WINDOW bytes that covers it also starts earlier: in a document with a smaller id, or earlier
in the same one. Not every suffix needs sorting: every window holds an anchor, its gram with the smallest hash, and equal
windows have equal anchors. Anchors that occur once hold no repeat. Of the others the surrounding bytes (all windows that
share the anchor) are gathered by anchor, copies collapsed to their earliest holder before and after the shuffle. Where
one anchor has different surroundings, the suffixes at their windows are sorted: by characters of eight bytes down to a
shallow depth, each level of all groups at once by a library sort in place of quicksort's partitions, then by blind tries for
the groups that still share a prefix. Suffixes that end up in one leaf share WINDOW bytes; all but the earliest are repeats.

Anchors that are very frequent (a bounded list) are dealt out by the window's content instead, so no task gets a group
that grows with the corpus.

Defined results: a null text is empty. A null id ranks after all others. Rows that share an id are versions of one
document: of equal strings the earlier start counts, and strings that start at the same place don't remove one another,
so a repeated row gets the same result again. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import (
    PACKED_DDL,
    Chunk,
    by_bucket,
    chunked,
    dealt,
    one_by_one,
    opened,
    pack,
    packed,
    spans_by_row,
    unpack,
    with_answers,
)
from tidemark.llm.common import mix, shuffle_width, staged

WINDOW = 100
#: Bytes of an anchor: short enough that few windows share one, long enough that few texts do.
GRAM = 24
#: Places an anchor can have in a window.
PLACES = WINDOW - GRAM + 1
#: Depth to which suffixes are sorted before tries take over.
SHALLOW = 32
#: An anchor with fewer occurrences is never dealt out by content.
FREQUENT = 4096
#: Bytes worked on at a time; below 2**20, as places share a word with hashes.
STEP = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(256), 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at every place, doubled up from single bytes."""

    def joined(a: np.ndarray, b: np.ndarray, length_a: int, length_b: int) -> np.ndarray:
        n = max(0, len(b) - length_a)
        return a[:n] * np.uint64(pow(_BASE, length_b, 1 << 64)) + b[length_a : length_a + n]

    power = {1: _BYTE[data]}
    length = 1
    while length * 2 <= GRAM:
        power[length * 2] = joined(power[length], power[length], length, length)
        length *= 2
    whole, done = power[length], length
    while done < GRAM:
        length = max(k for k in power if k <= GRAM - done)
        whole = joined(whole, power[length], done, length)
        done += length
    whole = (whole ^ (whole >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(29))


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, number of windows, anchor's distance from the first, its hash."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width * 2 <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < PLACES:
        least = np.minimum(least[: len(least) - (PLACES - width)], least[PLACES - width :])
    anchor = (least & _PLACE).astype(np.int64)
    # Windows that would cross the end of a document are none.
    whole = np.ones(len(anchor), bool)
    for end in offsets[1:].tolist():
        whole[max(0, end - WINDOW + 1) : end] = False
    change = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(whole & np.concatenate([[True], change]))
    last = np.flatnonzero(whole & np.concatenate([change, [True]]))
    return first, last - first + 1, anchor[first] - first, hashes[anchor[first]]


def chunk_anchors(chunk: Chunk) -> tuple[np.ndarray, ...]:
    """Anchor runs of a chunk: row, first window in the document, windows, distance, hash."""
    found = []
    for a, b in chunk.groups(STEP):
        begin, end = chunk.offsets[a], chunk.offsets[b]
        # A long document is cut into stretches that overlap by all but one byte of a window.
        for at in range(begin, max(begin + 1, end - WINDOW + 1 if b == a + 1 else begin + 1), STEP):
            stop = min(end, at + STEP + WINDOW - 1) if b == a + 1 else end
            offsets = np.clip(chunk.offsets[a : b + 1], at, stop) - at
            first, n, distance, hashes = _anchors(chunk.data[at:stop], offsets)
            row = np.searchsorted(chunk.offsets[a + 1 : b + 1], first + at, side="right") + a
            found.append((row, first + at - chunk.offsets[row], n, distance, hashes))
    if not found:
        found = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _hits(row, first, n, distance, hashes) -> bytes:
    return pack(row.astype("<u4"), first.astype("<u4"), n.astype("u1"), distance.astype("u1"), hashes.astype("<u8"))


HIT = ("u4", "u4", "u1", "u1", "u8")


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for key, chunk, _ in opened(batch):
                row, first, n, distance, hashes = chunk_anchors(chunk)
                order = np.argsort(hashes, kind="stable")
                new = np.concatenate([[True], np.diff(hashes[order]) != 0]) if len(order) else np.zeros(0, bool)
                starts = np.flatnonzero(new)
                counts = np.diff(np.append(starts, len(order)))
                # What repeats within the chunk is known to repeat; others learn of it from one entry per hash.
                again = order[np.repeat(counts > 1, counts)]
                out = []
                if len(again):
                    out.append((key % buckets, key, "hit", _hits(row[again], first[again], n[again], distance[again], hashes[again])))
                one = order[starts]
                for bucket, at in by_bucket(hashes[one] % np.uint64(buckets), buckets):
                    e = one[at]
                    data = pack(
                        hashes[e].astype("<u8"), counts[at].astype("<u4"), row[e].astype("<u4"), first[e].astype("<u4"),
                        n[e].astype("u1"), distance[e].astype("u1"),
                    )
                    out.append((bucket, key, "entry", data))
                if out:
                    yield packed(out)

    return run


def _find_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to chunks: which of their single anchors occur in another one; and how frequent anchors are."""
    parts, keys = [], []
    for batch in batches:
        for kind, key, payload in zip(batch.column("kind").to_pylist(), batch.column("chunk").to_pylist(), batch.column("payload"), strict=True):
            if kind == "hit":
                yield packed([(0, key, "hit", payload.as_py())])
            else:
                parts.append(unpack(payload.as_py(), "u8", "u4", "u4", "u4", "u1", "u1"))
                keys.append(key)
    if not parts:
        return
    hashes, counts, row, first, n, distance = (np.concatenate(x) for x in zip(*parts, strict=True))
    sender = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    del parts
    order = np.argsort(hashes, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    total = np.add.reduceat(counts[order].astype(np.int64), starts)
    hit = order[(total[group] > 1) & (counts[order] == 1)]
    for s, at in by_bucket(sender[hit], len(keys)):
        e = hit[at]
        yield packed([(0, keys[s], "hit", _hits(row[e], first[e], n[e], distance[e], hashes[e]))])
    frequent = total > FREQUENT
    rows = [(0, -1, "total", pack(total.sum(keepdims=True).astype("<u8")))]
    if frequent.any():
        rows.append((0, -1, "frequent", pack(hashes[order][starts][frequent].astype("<u8"), total[frequent].astype("<u8"))))
    yield packed(rows)


def _frequent(found: DataFrame, spark) -> np.ndarray:
    """Hashes of anchors with more than their share of all occurrences: at most 64 per shuffle partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                hashes, totals = unpack(payload.as_py(), "u8", "u8")
                yield pa.RecordBatch.from_arrays([pa.array(hashes.astype(np.int64)), pa.array(totals.astype(np.int64))], ["hash", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [int(unpack(p.as_py(), "u8")[0][0]) for p in batch.column("payload")]
            yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int64())], ["n"])

    total = found.where("kind = 'total'").mapInArrow(add, "n long").agg(F.sum("n")).first()[0] or 0
    bound = max(FREQUENT, total // (64 * shuffle_width(spark)))
    rows = found.where("kind = 'frequent'").mapInArrow(count, "hash long, total long").where(F.col("total") > bound)
    return np.array(sorted(r["hash"] for r in rows.select("hash").collect()), np.int64).view(np.uint64)


class Holders:
    """Distinct byte strings with their earliest holder; all later holders are repeats.

    A holder is (id, start, sender): holders at the same place of the same document don't remove one another.
    """

    def __init__(self):
        self.best: dict[bytes, tuple] = {}
        self.ties: dict[bytes, list[tuple]] = defaultdict(list)
        self.repeats: list[tuple] = []

    def add(self, string: bytes, holder: tuple) -> None:
        best = self.best.setdefault(string, holder)
        if best is holder:
            return
        if holder[:2] > best[:2]:
            self.repeats.append((holder, len(string)))
        elif holder[:2] == best[:2]:
            self.ties[string].append(holder)
        else:
            self.best[string] = holder
            self.repeats += [(x, len(string)) for x in (best, *self.ties.pop(string, ()))]

    def all(self, string: bytes) -> list[tuple]:
        return [self.best[string], *self.ties.get(string, ())]


SPAN = ("u4", "u4", "u4")


def _spans(row, start, end) -> bytes:
    return pack(np.asarray(row, "<u4"), np.asarray(start, "<u4"), np.asarray(end, "<u4"))


def _send_surroundings(buckets: int, frequent: np.ndarray):
    """Ships the distinct surroundings of repeated anchors; answers for copies within the chunk at once."""
    often = set(frequent.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for key, chunk, answers in opened(batch):
                if not answers:
                    continue
                row, first, n, distance, hashes = (np.concatenate(x) for x in zip(*(unpack(a, *HIT) for a in answers), strict=True))
                view = memoryview(chunk.data)
                ids = chunk.ids
                at = (chunk.offsets[row] + first).tolist()
                held = Holders()
                group: dict[bytes, int] = {}
                for r, f, k, h, a in zip(row.tolist(), first.tolist(), n.tolist(), hashes.tolist(), at, strict=True):
                    if h in often:
                        for i in range(k):
                            window = bytes(view[a + i : a + i + WINDOW])
                            held.add(window, (int(ids[r]), f + i, r))
                    else:
                        string = bytes(view[a : a + k + WINDOW - 1])
                        group[string] = h
                        held.add(string, (int(ids[r]), f, r))
                out = []
                if held.repeats:
                    out.append((key % buckets, key, "span", _spans(*zip(*((x[2], x[1], x[1] + size) for x, size in held.repeats), strict=True))))
                strings = [(s, x) for s in held.best for x in held.all(s)]
                if strings:
                    own = np.array([group[s] if s in group else xxhash.xxh3_64_intdigest(s) for s, _ in strings], np.uint64)
                    for bucket, places in by_bucket(mix(own, 3) % np.uint64(buckets), buckets):
                        some = [strings[i] for i in places.tolist()]
                        sizes = np.array([len(s) for s, _ in some], "<u1")
                        head = pack(
                            own[places].astype("<u8"), np.array([x[0] for _, x in some], "<i8"), np.array([x[1] for _, x in some], "<u4"),
                            np.array([x[2] for _, x in some], "<u4"), sizes,
                        )
                        out.append((bucket, key, "strings", len(some).to_bytes(4, "little") + head + b"".join(s for s, _ in some)))
                if out:
                    yield packed(out)

    return run


def _find_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, group = Holders(), {}
    keys: list[int] = []
    for batch in batches:
        for kind, key, payload in zip(batch.column("kind").to_pylist(), batch.column("chunk").to_pylist(), batch.column("payload"), strict=True):
            data = payload.as_py()
            if kind == "span":
                yield packed([(0, key, "span", data)])
                continue
            size = int.from_bytes(data[:4], "little")
            hashes, ids, first, row, sizes = unpack(data[4 : 4 + size * 25], "u8", "i8", "u4", "u4", "u1")
            at = 4 + size * 25
            sender = len(keys)
            keys.append(key)
            for h, i, f, r, k in zip(hashes.tolist(), ids.tolist(), first.tolist(), row.tolist(), sizes.tolist(), strict=True):
                string = data[at : at + k]
                at += k
                group[string] = h
                held.add(string, (i, f, sender, r))
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for (_, start, sender, row), size in held.repeats:
        found[sender].append((row, start, start + size))
    # Different surroundings of one anchor may still share windows.
    members: dict[int, list[bytes]] = defaultdict(list)
    for string, h in group.items():
        members[h].append(string)
    texts = [s for group_ in members.values() if len(group_) > 1 for s in group_]
    del members, group
    for text, offset in repeated_windows(texts, [held.best[s][:2] for s in texts]):
        for _, start, sender, row in held.all(texts[text]):
            found[sender].append((row, start + offset, start + offset + WINDOW))
    for sender, spans in found.items():
        yield packed([(0, keys[sender], "span", _spans(*zip(*spans, strict=True)))])


def repeated_windows(texts: list[bytes], places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(text, offset) of every window that also starts earlier; ``places`` are (id, start) of each text."""
    if not texts:
        return
    sizes = np.array([len(t) for t in texts])
    windows = sizes - WINDOW + 1
    text = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = (np.cumsum(sizes) - sizes)[text] + offset
    ids = np.array([p[0] for p in places], np.int64)
    start = np.array([p[1] for p in places], np.int64)
    for group in equal_prefixes(b"".join(texts), begin, WINDOW):
        members = np.array(group)
        owner = text[members]
        place = start[owner] + offset[members]
        earliest = min(zip(ids[owner].tolist(), place.tolist(), strict=True))
        for m, i, p in zip(group, ids[owner].tolist(), place.tolist(), strict=True):
            if (i, p) > earliest:
                yield int(text[m]), int(offset[m])


def equal_prefixes(data: bytes, begin: np.ndarray, depth: int) -> Iterator[list[int]]:
    """Groups of suffixes (by number) that share ``depth`` bytes, in lexicographic order; single suffixes are left out.

    Deep-shallow sorting: characters of eight bytes split the suffixes, group by group, until SHALLOW bytes are equal;
    what is left are few groups with long common prefixes, and a blind trie orders each of them.
    """
    raw = np.frombuffer(data + bytes(8), np.uint8)
    n = len(data)
    character = np.zeros(n, np.uint64)
    for i in range(8):
        character = (character << np.uint64(8)) | raw[i : i + n]
    active = np.arange(len(begin))
    group = np.zeros(len(begin), np.int64)
    shallow = min(SHALLOW, depth) // 8 * 8
    for level in range(0, shallow, 8):
        key = character[begin[active] + level]
        order = np.lexsort((key, group)) if level else np.argsort(key, kind="stable")
        active, group, key = active[order], group[order], key[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(active)))
        keep = np.repeat(counts > 1, counts)
        group = np.repeat(np.arange(len(starts)), counts)[keep]
        active = active[keep]
        if not len(active):
            return
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.append(starts[1:], len(active))
    numbers, places = active.tolist(), begin[active].tolist()
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        yield from blind_trie(data, numbers[a:b], places[a:b], shallow, depth)


def blind_trie(data: bytes, numbers: list[int], places: list[int], start: int, depth: int) -> Iterator[list[int]]:
    """Leaves, in order, that hold several suffixes equal up to ``depth``; all share their first ``start`` bytes.

    An inner node is (length of the common prefix, children by next byte); a leaf is the list of its suffixes. A suffix
    walks down by single bytes, blindly, to any leaf below; comparing with that one leaf tells where it branches off.
    """
    bits = 8 * (depth - start)
    root: object = None
    first: dict[int, bytes] = {}
    for number, place in zip(numbers, places, strict=True):
        own = data[place + start : place + depth]
        if root is None:
            root = [number]
            first[number] = own
            continue
        node, path = root, []
        while type(node) is tuple:
            path.append(node)
            children = node[1]
            node = children.get(own[node[0]]) or next(iter(children.values()))
        other = first[node[0]]
        if own == other:
            node.append(number)
            continue
        first[number] = own
        common = (bits - (int.from_bytes(own, "big") ^ int.from_bytes(other, "big")).bit_length()) // 8
        # The branching point lies above the first node on the path that is deeper.
        above = None
        for above_ in path:
            if above_[0] > common:
                break
            above = above_
        if above is not None and above[0] == common:
            above[1][own[common]] = [number]
            continue
        below = root if above is None else above[1][other[above[0]]]
        split = (common, {other[common]: below, own[common]: [number]})
        if above is None:
            root = split
        else:
            above[1][other[above[0]]] = split
    stack = [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        elif len(node) > 1:
            yield node


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as chunks, answered by the spans of bytes to remove."""
    spark = docs.sparkSession
    buckets = shuffle_width(spark)
    chunks = chunked(docs, id_col, text_col)
    entries = chunks.mapInArrow(_send_anchors(buckets), PACKED_DDL)
    found = staged(dealt(entries).mapInArrow(_find_repeated, PACKED_DDL), "anchors")
    frequent = _frequent(found, spark)
    asked = with_answers(chunks, found.where("kind = 'hit'")).mapInArrow(_send_surroundings(buckets, frequent), PACKED_DDL)
    spans = dealt(asked).mapInArrow(_find_spans, PACKED_DDL)
    return with_answers(chunks, spans)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; with ``texts`` also the spans and kept bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for _, chunk, answers in opened(batch):
                answers = [unpack(a, *SPAN) for a in answers] or [[np.zeros(0, "<u4")] * 3]
                of = spans_by_row(*(np.concatenate(x) for x in zip(*answers, strict=True)))
                rows = []
                for i in range(len(chunk)):
                    text = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]]
                    starts, ends = of(i)
                    kept = text
                    if len(starts):
                        stay = np.ones(len(text), bool)
                        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                            stay[a:b] = False
                        kept = text[stay]
                    row = {
                        "doc_id": int(chunk.ids[i]) if chunk.known[i] else None,
                        "n_bytes": len(text),
                        "n_removed": len(text) - len(kept),
                        "n_spans": len(starts),
                        "kept_sha256": hashlib.sha256(kept.tobytes()).hexdigest(),
                    }
                    if texts:
                        row |= {"starts": starts.tolist(), "ends": ends.tolist(), "kept": kept.tobytes()}
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = [("doc_id", pa.int64(), "long"), ("n_bytes", pa.int64(), "long"), ("n_removed", pa.int64(), "long")]
    kinds += [("n_spans", pa.int64(), "long"), ("kept_sha256", pa.string(), "string")]
    if texts:
        kinds += [("starts", pa.list_(pa.int64()), "array<long>"), ("ends", pa.list_(pa.int64()), "array<long>"), ("kept", pa.binary(), "binary")]
    schema = pa.schema([(n, t) for n, t, _ in kinds])
    return repeated_spans(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{n} {t}" for n, _, t in kinds))
