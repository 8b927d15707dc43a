"""Substring dedup: words inside any repeated run of ``WINDOW`` words go.

Seed and extend, over documents in chunks. A window of 35 words always holds
its anchor: of the hashes of its 12-word grams the least (winnowing), which two
equal windows choose at the same place.

1. Seed: each chunk asks which of its anchors any other chunk holds. Anchors
   that are met nowhere else can't lie in a repeated window.
2. Extend: around each anchor that is met again, every window holding it, from
   23 words to its left to 23 words to its right, is hashed and asked for.
   A window met elsewhere, in any chunk or in the same one, extends a match to
   both sides to 35 words at least.
3. The union of a document's repeated windows is its maximal repeats; their
   words go.

Joins between documents are on hashes only and pairs are never made: a chunk
learns a bit a key, and a passage shared by a third of all documents costs one
key a chunk. Windows are compared by 64-bit hashes of 64-bit word hashes.

Defined cases: a null, empty or blank text has no words; with fewer than 35
words nothing goes. Rows repeated as they are repeat each other, whatever their
doc_id, null too. Windows never cross documents. Extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import REQUEST, Text, answers, distinct, grams, least_in_windows, mixed, read_answers, requests, stage
from .common import staged

WINDOW = 35
SEED = 12
# About so many keys are asked for a byte of text, by round; sets the number of ranges.
KEYS_A_BYTE = {1: 0.016, 2: 0.05}

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.cumprod(np.concatenate([[1], np.full((1 << 16) - 1, 0x9E3779B97F4A7C15)]).astype(np.uint64))


class Words(Text):
    """The words of a chunk: where they begin and end, and a hash of each."""

    def __init__(self, table: pa.Table, fold: np.ndarray | None = None):
        super().__init__(table)
        if fold is not None:
            self.data = fold[self.data]
        ink = ~_BLANK[self.data]
        edge = np.flatnonzero(ink[1:] != ink[:-1]) + 1
        edge = np.concatenate([[0], edge]) if len(ink) and ink[0] else edge
        self.from_, self.to = edge[::2], edge[1::2]  # the last byte is blank, so each word has an end
        self.first = np.searchsorted(self.from_, self.begin)  # word of each document
        self.last = np.searchsorted(self.from_, self.end)
        self.ink = np.flatnonzero(ink)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        if not len(self.from_):
            return np.zeros(0, np.uint64)
        size = self.to - self.from_
        at = self.ink - np.repeat(self.from_, size)
        letters = self.data[self.ink].astype(np.uint64) + np.uint64(1)
        start = np.cumsum(size) - size
        one = np.add.reduceat(letters * _POWERS[at & 0xFFFF], start)
        two = np.add.reduceat(mixed(letters | (at.astype(np.uint64) << np.uint64(9))), start)
        return mixed(one ^ (two * np.uint64(0xD6E8FEB86659FD93)))

    def windows(self, n: int) -> np.ndarray:
        """First words of the windows of n words within a document."""
        count = np.maximum(0, self.last - self.first - n + 1)
        return np.repeat(self.first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Seeds:
    """A chunk's windows and the anchor of each."""

    def __init__(self, w: Words):
        self.words = w
        self.window = w.windows(WINDOW)
        self.gram = grams(w.hash, SEED)
        self.anchor = least_in_windows(self.gram, WINDOW - SEED + 1)[self.window]
        new = np.concatenate([[True], self.anchor[1:] != self.anchor[:-1]]) if len(self.anchor) else np.zeros(0, bool)
        self.nth = np.cumsum(new) - 1  # of each window: its anchor's number
        self.keys, self.which, self.times = distinct(self.gram, self.anchor[new])

    def extended(self, replies: pa.Table, n_ranges: int) -> tuple:
        """The windows around anchors met again, and the distinct keys of them."""
        met = read_answers(replies, 1, self.keys, n_ranges, bits=True) | (self.times > 1)
        window = self.window[met[self.which][self.nth]]
        return window, *distinct(grams(self.words.hash, WINDOW), window)


def substring_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one
    blank) of every row of ``docs``, and the hash of kept."""
    chunks = stage(docs, text)
    n1, n2 = chunks.ranges(KEYS_A_BYTE[1]), chunks.ranges(KEYS_A_BYTE[2])

    def seed(table: pa.Table) -> pa.Table:
        s = Seeds(Words(table))
        return requests(s.words.chunk, s.keys, n1)

    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        s = Seeds(Words(table))
        return requests(s.words.chunk, s.extended(replies, n1)[1], n2)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        w = Words(table)
        s = Seeds(w)
        window, keys, which, times = s.extended(replies, n1)
        again = window[(read_answers(replies, 2, keys, n2, bits=True) | (times > 1))[which]]
        step = np.zeros(len(w.from_) + 1, np.int64)
        np.add.at(step, again, 1)
        np.add.at(step, again + WINDOW, -1)
        keep = np.cumsum(step)[:-1] == 0
        size = w.to - w.from_
        data, take = w.data.copy(), np.zeros(len(w.data), bool)
        take[w.ink[np.repeat(keep, size)]] = True
        take[w.to[keep]] = True  # one blank after each word
        data[w.to] = 32
        upto = np.concatenate([[0], np.cumsum(take)])
        out, kept = data[take].tobytes(), np.concatenate([[0], np.cumsum(keep)])
        texts = [out[upto[b]:max(upto[b], upto[e + 1] - 1)] for b, e in zip(w.begin, w.end)]
        return pa.table({
            "doc_id": w.doc_id, "n_words": pa.array(w.last - w.first), "n_removed": pa.array(w.last - w.first - kept[w.last] + kept[w.first]),
            "kept": pa.array(texts, pa.binary()).cast(pa.string()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts])})

    first = staged(answers(chunks.map(seed, REQUEST), in_two_chunks, 1, bits=True), "seeds-met")
    second = answers(chunks.map_with(first, extend, REQUEST), in_two_chunks, 2, bits=True)
    return chunks.map_with(first.unionAll(second), cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def in_two_chunks(n: np.ndarray, _) -> np.ndarray:
    return n > 1
