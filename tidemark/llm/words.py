"""Words of UTF-8 texts as arrays: runs of bytes other than blanks and the controls 9 to 13."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix

#: Bytes hashed at a time; longer texts are cut where words end.
STEP = 1 << 19
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(256), 2)
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS = {b: np.ones(1, np.uint64) for b in (_BASE, _INVERSE)}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, doubled up and remembered by the worker."""
    known = _POWERS[base]
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
    _POWERS[base] = known
    return known[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, in order, and the n + 1 offsets of each document's words."""
    if len(data) > 2 * STEP and len(offsets) == 2:
        return _long(data)
    word = _WORD[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    # A document ends the word it ends in.
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] |= word[heads]
    first = np.flatnonzero(begins)
    ends = word.copy()
    ends[:-1] &= ~word[1:] | begins[1:]
    last = np.flatnonzero(ends)
    sums = np.cumsum(np.where(word, _BYTE[data], np.uint64(0)) * _powers(_BASE, len(data)), dtype=np.uint64)
    before = np.where(first > 0, sums[first - 1], np.uint64(0)) if len(first) else np.zeros(0, np.uint64)
    hashes = (sums[last] - before) * _powers(_INVERSE, len(data))[first]
    # The length tells words apart that differ by bytes of hash zero; mixing spreads what differs.
    return mix(hashes + (last - first).astype(np.uint64)), np.searchsorted(first, offsets)


def _long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + STEP)
        while end < len(data):
            blanks = np.flatnonzero(~_WORD[data[end : end + STEP]])
            if len(blanks):
                end += int(blanks[0])
                break
            end = min(len(data), end + STEP)
        piece = data[at:end]
        parts.append(_whole(piece))
        at = end
    hashes = np.concatenate(parts)
    return hashes, np.array([0, len(hashes)])


def _whole(piece: np.ndarray) -> np.ndarray:
    """Hashes of a piece that begins and ends between words; an extremely long word stays whole."""
    return word_hashes(np.concatenate([piece, np.frombuffer(b" ", np.uint8)]), np.array([0, len(piece), len(piece) + 1]))[0]


def rolling(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every n consecutive words, doubled up; shorter input gives none."""
    base = (_BASE * (2 * seed + 1)) % (1 << 64)

    def joined(a: np.ndarray, b: np.ndarray, length_a: int, length_b: int) -> np.ndarray:
        k = max(0, len(b) - length_a)
        return a[:k] * np.uint64(pow(base, length_b, 1 << 64)) + b[length_a : length_a + k]

    known, length = {1: hashes}, 1
    while length * 2 <= n:
        known[length * 2] = joined(known[length], known[length], length, length)
        length *= 2
    whole, done = known[length], length
    while done < n:
        length = max(k for k in known if k <= n - done)
        whole = joined(whole, known[length], done, length)
        done += length
    return mix(whole, seed)


def within(starts_offsets: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` places start n words of a single document, given the documents' word offsets."""
    inside = np.zeros(total + 1, np.int64)
    sizes = np.diff(starts_offsets)
    long = sizes >= n
    np.add.at(inside, starts_offsets[:-1][long], 1)
    np.add.at(inside, starts_offsets[1:][long] - n + 1, -1)
    return np.cumsum(inside[:-1]) > 0
